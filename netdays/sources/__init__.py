"""Where rows come from and go to: ERP relations, files, the offer ledger."""
