"""Personal data replaced by surrogates, with DataFrame functions only.

One pattern finds emails, phone and card numbers, addresses, account numbers,
secrets and titled names. Each find is cut into parts; a part that identifies is
reduced to its canonical form (digits of a number, lower case of an email, each word
of a name), and equal forms are one entity. An entity's surrogate is drawn by a keyed
hash: characters of the same class at the same places, valid check digits and
octets, and names of the same gender, script and spelling. Two entities with one
surrogate, or a surrogate that is some entity's own form, are found by aggregation
over the whole table and drawn anew until all are distinct, after many draws as
longer ones, so that no form runs out. Every occurrence then
gets its entity's surrogate in its own format, so what referred to one thing still does:
a given name is one entity under all titles, and where a text holds a titled name, the
same words get the same surrogates elsewhere in it without a title.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netdays.llm.common import written

# Titles by the gender they state.
MALE = "Mr|Mister|Herr|Herrn|Señor|Sr|Monsieur|Г-н|Господин|Κύριος"
FEMALE = "Mrs|Ms|Miss|Frau|Señora|Sra|Señorita|Madame|Mme|Mademoiselle|Mlle|Г-жа|Госпожа|Κυρία"
NEUTRAL = "Dr|Prof"

# Given names by gender and script, and parts of family names by script.
GIVEN = {
    ("m", "latin"): "Adam Bruno Carl David Erik Felix Georg Hugo Ivan Jonas Karl Leon Martin Noel Oscar Paul Robert Simon Thomas Victor",
    ("f", "latin"): "Alice Bella Clara Diana Elena Flora Greta Helena Irene Julia Karin Laura Maria Nora Olivia Paula Rosa Sofia Teresa Vera",
    ("u", "latin"): "Alex Ariel Billie Charlie Dana Eden Jamie Jean Kim Lou Noa Pat Quinn Robin Sam Sascha Toni Val Wren Yael",
    ("m", "cyrillic"): "Андрей Борис Виктор Глеб Денис Егор Иван Кирилл Леонид Максим Никита Олег Павел Роман Сергей Тимур",
    ("f", "cyrillic"): "Анна Вера Галина Дарья Елена Жанна Зоя Ирина Ксения Лариса Мария Нина Ольга Полина Раиса Софья",
    ("u", "cyrillic"): "Женя Саша Валя Слава Паша Шура",
    ("m", "greek"): "Αλέξανδρος Γιώργος Δημήτρης Ηλίας Κώστας Λευτέρης Νίκος Πέτρος Σπύρος Χρήστος",
    ("f", "greek"): "Αγγελική Βασιλική Δήμητρα Ελένη Ιωάννα Κατερίνα Μαρία Σοφία Φωτεινή Χριστίνα",
    ("u", "greek"): "Άλεξ Χάρις",
}
FAMILY = {
    "latin": "Al Ber Cor Dal El Fen Gar Hol Is Jor Kel Lin Mar Nor Ol Per Ros Sel Tor Ul Ven Wal",
    "cyrillic": "Ал Бер Вол Гор Дан Ел Зор Ил Кар Лар Мор Нел Ор Пол Рад Сол",
    "greek": "Αλ Βερ Γαλ Δαν Ελ Καρ Λαμ Μαρ Νικ Παπ Σαλ Τρι",
}

_LEFT, _RIGHT = r"(?<![\p{L}\p{N}_.@-])", r"(?![\p{L}\p{N}_@-])"
# What each alternative of the pattern finds; earlier ones win where two start alike.
PATTERNS = {
    "secret": (
        r"(?<![\p{L}\p{N}])(?i:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)"
        r"[\"']?\s{0,3}[=:]\s{0,3}[\"']?(?=[_+/.~-]*+[A-Za-z0-9])[A-Za-z0-9_+/.~-]{6,}+"
    ),
    "key": r"(?<![\p{L}\p{N}])(?:AKIA[0-9A-Z]{16}|ghp_[A-Za-z0-9]{36}|sk_live_[A-Za-z0-9]{16,}+)(?![\p{L}\p{N}])",
    "email": r"(?<![\p{L}\p{N}._%+@-])[\p{L}\p{N}._%+-]{1,128}+@(?:[\p{L}\p{N}-]{1,63}+\.){1,8}\p{L}{2,24}(?![\p{L}\p{N}@])",
    "ip": _LEFT + r"(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\p{L}\p{N}_]|\.\d)",
    "ssn": _LEFT + r"\d{3}-\d{2}-\d{4}" + _RIGHT,
    "iban": _LEFT + r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?" + _RIGHT,
    "card": (
        _LEFT + r"(?:\d{4}[ -]){3}\d{1,7}" + _RIGHT + "|" + _LEFT + r"\d{4}[ -]\d{6}[ -]\d{4,5}" + _RIGHT
        + "|" + _LEFT + r"\d{13,19}" + _RIGHT
    ),
    "phone": (
        r"(?<![\p{L}\p{N}_.+-])(?:(?:\+\d{1,3}|1)[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]\d{3,5}" + _RIGHT
        + r"|(?<![\p{L}\p{N}_.+-])\+\d{1,3}(?:[ .-]\d{2,5}){2,5}" + _RIGHT
        + r"|(?<![\p{L}\p{N}_.+-])\+(?:\d{8,15}|\d{1,3}[ .-]\d{6,12})" + _RIGHT
        + "|" + _LEFT + r"(?:1[ .-])?\d{3}[ .-]\d{3}[ .-]\d{4}" + _RIGHT
    ),
    "name": (
        rf"(?<![\p{{L}}\p{{N}}])(?:{MALE}|{FEMALE}|{NEUTRAL})\.?(?:[  ]\p{{Lu}}(?:(?!['’]s(?!\p{{L}}))(?:\p{{L}}|['’-](?=\p{{L}}))){{1,40}}+){{1,4}}"
    ),
}
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS.values())
# Cheap to look for: texts without any of these hold nothing that the pattern finds.
HINT = rf"[0-9@=:]|(?:{MALE}|{FEMALE}|{NEUTRAL})\.?[  ]"


@dataclass(frozen=True)
class Settings:
    """``key`` makes surrogates what they are; without it they can't be traced back.

    After ``rounds`` draws of an entity's own length each further draw is a character longer.
    """

    key: str = "surrogate-key"
    rounds: int = 40


def _parts(found: Column) -> Column:
    """A find as literal parts (no kind) and identifying parts ``(kind, text)``."""

    def part(kind: str | None, text: Column) -> Column:
        return F.struct(F.lit(kind).cast("string").alias("kind"), text.alias("text"))

    def whole(kind: str) -> Column:
        return F.array(part(kind, found))

    def cut(expression: str, group: int) -> Column:
        return F.regexp_extract(found, expression, group)

    labelled = r"^([\p{L}_\-]+[\"']?\s{0,3}[=:]\s{0,3}[\"']?)(.*)$"
    gender = (
        F.when(found.rlike(rf"^(?:{MALE})\.?[  ]"), "m").when(found.rlike(rf"^(?:{FEMALE})\.?[  ]"), "f").otherwise("u")
    )
    words = F.regexp_extract_all(found, F.lit("[  ]|[^  ]+"), 0)  # the title, then blank and name by turns
    named = F.transform(words, lambda word, i: F.struct(
        F.when((i == 0) | (i % 2 == 1), F.lit(None)).when(i == F.size(words) - 1, "family")
        .otherwise(F.concat(F.lit("given_"), gender)).alias("kind"),
        word.alias("text"),
    ))
    out = F.when(found.rlike(f"^(?:{PATTERNS['secret']})$"), F.array(part(None, cut(labelled, 1)), part("key", cut(labelled, 2))))
    for kind in ("key", "email", "ip", "ssn", "iban", "card", "phone"):
        out = out.when(found.rlike(f"^(?:{PATTERNS[kind]})$"), whole(kind))
    return out.otherwise(named)


NUMBERS = ("ssn", "card", "phone")


def _space(kind: Column) -> Column:
    """Kinds whose entities and surrogates are told apart: given names are one, whatever gender."""
    return F.when(kind.startswith("given"), "given").otherwise(kind)


def _canonical(kind: Column, text: Column) -> Column:
    return (
        F.when(kind.isin(*NUMBERS), F.regexp_replace(text, r"[^\p{Nd}]", ""))
        .when(kind == "email", F.lower(text)).when(kind == "iban", F.regexp_replace(text, " ", ""))
        .when(kind.startswith("given") | (kind == "family"), F.initcap(F.lower(text)))
        .otherwise(text)
    )


def _draw(settings: Settings, salt: Column, at: Column, of: int) -> Column:
    """A keyed number below ``of`` for a place of an entity, of whose form ``digest`` is the hash."""
    digest = F.sha2(F.concat_ws("\u0001", F.lit(settings.key), F.col("kind"), F.col("digest"), salt.cast("string"), at.cast("string")), 256)
    return F.pmod(F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint"), F.lit(of))


def _letters(alphabet: str, n: Column) -> Column:
    return F.substring(F.lit(alphabet), n.cast("int") + 1, F.lit(1))


def _likewise(settings: Settings, text: Column, salt: Column) -> Column:
    """Text with every letter and digit replaced by another one of its class."""
    hexadecimal = F.col("hexadecimal")

    def one(c: Column, i: Column) -> Column:
        def pick(alphabet: str) -> Column:
            return _letters(alphabet, _draw(settings, salt, i, len(alphabet)))

        return (
            F.when(hexadecimal, pick("0123456789abcdef"))
            .when(c.rlike("[0-9]"), pick("0123456789")).when(c.rlike("[a-z]"), pick("abcdefghijklmnopqrstuvwxyz"))
            .when(c.rlike("[A-Z]"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
            .when(c.rlike(r"\p{IsCyrillic}"), pick("абвгдежзиклмнопрстуфхцчшэюя"))
            .when(c.rlike(r"\p{IsGreek}"), pick("αβγδεζηθικλμνξοπρστυφχψω"))
            .when(c.rlike(r"\p{L}"), pick("abcdefghijklmnopqrstuvwxyz")).otherwise(c)
        )

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _with_check_digit(digits: Column, original: Column) -> Column:
    """The last digit set so that the Luhn sum is valid where the original's is."""

    def total(number: Column) -> Column:
        places = F.transform(F.reverse(F.filter(F.split(number, ""), lambda c: c != "")), lambda c, i: F.when(
            i % 2 == 1, F.element_at(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), c.cast("int") + 1)
        ).otherwise(c.cast("int")))
        return F.aggregate(places, F.lit(0), lambda a, x: a + x)

    base = F.concat(F.expr("substring(drawn, 1, length(drawn) - 1)"), F.lit("0"))
    fixed = F.concat(F.expr("substring(drawn, 1, length(drawn) - 1)"), F.pmod(10 - total(base) % 10, F.lit(10)).cast("string"))
    return F.when(total(original) % 10 == 0, fixed).otherwise(digits)


def _script(text: Column) -> Column:
    return F.when(text.rlike(r"\p{IsCyrillic}"), "cyrillic").when(text.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _named(settings: Settings, salt: Column) -> Column:
    """A given or family name of the entity's gender and script; later draws have more parts."""

    def pick(names: str, at: Column) -> Column:
        choices = names.split()
        return F.element_at(F.array(*map(F.lit, choices)), (_draw(settings, salt, at, len(choices)) + 1).cast("int"))

    script, out = _script(F.col("canonical")), None
    for (gender, of), names in GIVEN.items():
        drawn = F.array_join(F.transform(F.sequence(F.lit(0), salt.cast("int")), partial(pick, names)), "-")
        condition = (F.col("kind") == f"given_{gender}") & (script == of)
        out = F.when(condition, drawn) if out is None else out.when(condition, drawn)
    for of, syllables in FAMILY.items():
        drawn = F.initcap(F.lower(F.array_join(F.transform(F.sequence(F.lit(0), salt.cast("int") + 2), partial(pick, syllables)), "")))
        out = out.when((F.col("kind") == "family") & (script == of), drawn)
    return out


def _digested(entities: DataFrame) -> DataFrame:
    """``entities`` with what their draws read in place of the form, which may be long."""
    return entities.withColumn("digest", F.sha2("canonical", 256)).withColumn(
        "hexadecimal", (F.col("kind") == "key") & F.col("canonical").rlike("^[0-9a-f]{12,}+$")
    )


def _drawn(settings: Settings, entities: DataFrame) -> DataFrame:
    """``entities`` with a ``surrogate`` each, drawn for their ``salt``."""
    salt, canonical = F.col("salt"), F.col("canonical")

    def octet(i: int, low: int, high: int) -> Column:
        return (_draw(settings, salt, F.lit(i), high - low + 1) + low).cast("string")

    further = F.greatest(salt.cast("int") - settings.rounds + 1, F.lit(0))

    def longer(text: Column, by: str) -> Column:
        return F.concat(text, F.repeat(F.lit(by), further))

    local, domain = longer(F.substring_index(canonical, "@", 1), "a"), F.substring_index(canonical, "@", -1)
    email = F.concat(
        _likewise(settings, local, salt), F.lit("@"),
        F.regexp_replace(_likewise(settings, F.concat(F.lit("."), domain), F.concat(salt.cast("string"), F.lit("d"))), r"^\.|[^.]*$", ""),
        F.lit("example"),
    )
    prefix = F.regexp_extract("canonical", "^(AKIA|ghp_|sk_live_)?", 1)
    bare = F.expr("substring(canonical, length(regexp_extract(canonical, '^(AKIA|ghp_|sk_live_)?', 1)) + 1)")
    key = F.concat(prefix, _likewise(settings, longer(bare, "0"), salt))
    iban = F.concat(F.substring("canonical", 1, 2), _likewise(settings, longer(F.expr("substring(canonical, 3)"), "0"), salt))
    octets = F.concat(
        F.array(octet(0, 1, 223), octet(1, 0, 255), octet(2, 0, 255), octet(3, 1, 254)),
        F.transform(F.array_repeat(F.lit(0), further), lambda _, i: (_draw(settings, salt, i + 4, 256)).cast("string")),
    )
    first = F.substring("canonical", 1, 1)
    likewise = _digested(entities).withColumn("drawn", _likewise(settings, longer(canonical, "0"), salt))
    return likewise.withColumn(
        "surrogate",
        F.when(F.col("kind") == "email", email)
        .when(F.col("kind") == "ip", F.array_join(octets, "."))
        .when(F.col("kind") == "card", _with_check_digit(F.col("drawn"), canonical))
        # A phone number's first digit stays: the country code, or what no number starts with.
        .when(F.col("kind") == "phone", F.concat(first, F.expr("substring(drawn, 2)")))
        .when(F.col("kind") == "key", key).when(F.col("kind") == "iban", iban)
        .when(F.col("kind") == "ssn", F.col("drawn")).otherwise(_named(settings, salt)),
    ).drop("drawn", "digest", "hexadecimal")


def assigned(entities: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``(kind, canonical, surrogate)``: a surrogate of its own for each distinct entity.

    ``entities`` has distinct ``(kind, canonical)``. Surrogates of one kind (given names of
    all genders are one) differ from each other and from all that kind's entities. An entity whose draw collides is
    drawn anew with the next salt; the one with the smallest form keeps a shared draw.
    Draws grow from ``settings.rounds`` on, so each entity finds one.
    """
    entities = written(entities, "entities")
    done, open_ = None, entities.withColumn("salt", F.lit(0))
    for attempt in count():
        drawn = written(_drawn(settings, open_), "drawn")
        space = _space(F.col("kind")).alias("space")
        winners = drawn.groupBy(space, "surrogate").agg(F.min(F.struct("canonical", "kind")).alias("first"))
        taken = entities.select(space, F.col("canonical").alias("surrogate"))
        if done is not None:
            taken = taken.unionByName(done.select(space, "surrogate"))
        fresh = written(winners.join(taken, ["space", "surrogate"], "left_anti").select("first.kind", "first.canonical", "surrogate"), "fresh")
        done = fresh if done is None else done.unionByName(fresh)
        open_ = written(
            drawn.join(fresh, ["kind", "canonical"], "left_anti").select("kind", "canonical", F.lit(attempt + 1).alias("salt")),
            "open",
        )
        if open_.isEmpty():
            return done


def _formatted(text: Column, surrogate: Column, kind: Column) -> Column:
    """A surrogate in the format of one occurrence."""
    digits = F.split(surrogate, "")
    characters = F.split(text, "")
    before = F.transform(
        F.sequence(F.lit(1), F.size(characters)),
        lambda i: F.length(F.regexp_replace(F.array_join(F.slice(characters, 1, i), ""), r"[^\p{Nd}]", "")),
    )
    numbered = F.concat(
        F.array_join(
            F.zip_with(characters, before, lambda c, n: F.when(c.rlike(r"\p{Nd}"), F.element_at(digits, n)).otherwise(c)), ""
        ),
        # A surrogate that had to be longer goes on behind the last digit.
        F.substring(surrogate, F.element_at(before, -1) + 1, F.length(surrogate)),
    )
    spaced = F.regexp_replace(surrogate, "(.{4})(?=.)", "$1 ")
    upper = (F.upper(text) == text) & (F.lower(text) != text)
    return (
        F.when(kind.isin(*NUMBERS), numbered)
        .when((kind == "iban") & text.contains(" "), spaced)
        .when(kind.startswith("given") | (kind == "family") | (kind == "email"), F.when(upper, F.upper(surrogate)).otherwise(surrogate))
        .otherwise(surrogate)
    )


def _entities(parts: DataFrame) -> DataFrame:
    """Distinct ``(kind, canonical)`` of parts; a given name is of the gender that its titles state."""
    stated = F.col("kind")
    one = parts.where("kind is not null").groupBy(_space(stated).alias("space"), "canonical").agg(
        F.bool_or(stated == "given_m").alias("m"), F.bool_or(stated == "given_f").alias("f")
    )
    gender = F.when(F.col("m") & ~F.col("f"), "m").when(F.col("f") & ~F.col("m"), "f").otherwise("u")
    return one.select(F.when(F.col("space") == "given", F.concat(F.lit("given_"), gender)).otherwise(F.col("space")).alias("kind"), "canonical")


def _mentions(names: Column) -> Column:
    """A pattern of a text's own names, longest first, that start with a capital."""
    longest = F.transform(
        F.array_distinct(F.transform(names, lambda n: n["canonical"])), lambda n: F.struct((-F.length(n)).alias("size"), n.alias("name"))
    )
    return F.concat(
        F.lit(r"(?<![\p{L}\p{N}])(?=\p{Lu})(?iu:"),
        F.array_join(F.transform(F.sort_array(longest), lambda n: n["name"]), "|"), F.lit(r")(?![\p{L}\p{N}])"),
    )


def _renamed(between: Column, names: Column, mentions: Column) -> Column:
    """The text between finds, with the names found in the same text replaced there too.

    A name right before another one is a given name, else a family name, where it is both.
    """
    literal = F.split(between, mentions, -1)
    mentioned = F.regexp_extract_all(between, mentions, F.lit(0))

    def surrogate(mention: Column, i: Column) -> Column:
        canonical = _canonical(F.lit("family"), mention)
        leads = F.get(literal, i + 1).isin(" ", "\u00a0") & (i + 1 < F.size(mentioned))
        of = F.filter(names, lambda n: n["canonical"] == canonical)
        wanted = F.filter(of, lambda n: (n["kind"] == "given") == leads)
        found = F.get(F.concat(wanted, of), F.lit(0))["surrogate"]
        return F.coalesce(F.when((F.upper(mention) == mention), F.upper(found)).otherwise(found), mention)

    spelled = F.concat(F.transform(mentioned, surrogate), F.array(F.lit("")))
    return F.array_join(F.zip_with(literal, spelled, lambda a, b: F.concat(a, b)), "")


def replaced(docs: DataFrame, settings: Settings = Settings(), counted: str | None = None) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced; all rows and columns stay.

    A text that is null or holds none is unchanged. ``counted`` names a further
    column with the number of finds, untitled mentions of names not among them. Equal texts get equal replacements, whatever
    their ids, nulls and repeats. Column names may be anything but start with ``__pii``.
    """
    # Whether there is a find costs one look at a text; finds are cut out only where there are any.
    holding = F.coalesce(F.col("text").rlike(HINT) & F.col("text").rlike(PATTERN), F.lit(False))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    number = lambda n: [] if counted is None else [n.alias(counted)]
    # Two hashes of the text are its name; rows without a find are never shuffled.
    named = [F.xxhash64("text").alias("__pii_one"), F.xxhash64(F.reverse("text")).alias("__pii_two")]
    finds = F.regexp_extract_all("text", F.lit(PATTERN), 0).alias("__pii_found")
    found = written(docs.where(holding).select(*columns, finds, *named), "found")
    key = ["__pii_one", "__pii_two"]
    parts = (
        found.select(*key, F.posexplode("__pii_found").alias("__pii_at", "find")).distinct()
        .select(*key, "__pii_at", F.posexplode(_parts(F.col("find"))).alias("part", "cut"))
        .select(*key, "__pii_at", "part", "cut.kind", "cut.text")
        .withColumn("canonical", F.when(F.col("kind").isNotNull(), _canonical(F.col("kind"), F.col("text"))))
    )
    parts = written(parts, "parts")
    surrogates = assigned(_entities(parts), settings).withColumn("kind", _space(F.col("kind")))
    spelled = parts.withColumn("kind", _space(F.col("kind"))).join(surrogates, ["kind", "canonical"], "left").withColumn(
        "text", F.when(F.col("surrogate").isNull(), F.col("text")).otherwise(_formatted(F.col("text"), F.col("surrogate"), F.col("kind")))
    )
    name = F.when(F.col("kind").isin("given", "family"), F.struct("kind", "canonical", "surrogate"))
    finds = spelled.groupBy(*key, "__pii_at").agg(
        F.collect_set(name).alias("names"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "text"))), lambda x: x["text"]), "").alias("with")
    )
    rows = written(
        finds.groupBy(*key).agg(
            F.transform(F.sort_array(F.collect_list(F.struct("__pii_at", "with"))), lambda x: x["with"]).alias("__pii_with"),
            F.array_distinct(F.flatten(F.collect_list("names"))).alias("__pii_names"),
        ).withColumn("__pii_mentions", F.when(F.size("__pii_names") > 0, _mentions(F.col("__pii_names")))),
        "replacements",
    )
    mentions, between = F.col("__pii_mentions"), F.split("text", PATTERN, -1)
    literal = F.when(
        mentions.isNotNull(), F.transform(between, lambda x: _renamed(x, F.col("__pii_names"), mentions))
    ).otherwise(between)
    rebuilt = F.array_join(F.zip_with(literal, F.concat("__pii_with", F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
    changed = found.join(rows, key).withColumn("text", rebuilt)
    return docs.where(~holding).select(*columns, *number(F.lit(0))).unionByName(
        changed.select(*columns, *number(F.size("__pii_found")))
    )
