"""DataFrame -> DataFrame building blocks, chained with ``DataFrame.transform``."""
