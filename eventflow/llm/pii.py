"""Personal data replaced by keyed surrogates of the same type, gender, script and format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, partitions, running, store, without

# Forms of address by gender (f, m, or x for either), and the syllables names are built from by script.
ADDRESS = {
    "f": "Mrs Ms Miss Frau Mme Mlle Madame Mademoiselle Sra Srta Señora Señorita Doña Signora г-жа Госпожа",
    "m": "Mr Herr Monsieur Señor Signor г-н Господин",
    "x": "Dr Prof Professor",
}
SYLLABLES = {
    "latin": "ba be bo da de do fa fi ga ka ke la le lo ma me mi na ne ni no ra re ri ro sa se so ta te to va vi wa za zo".split(),
    "cyrillic": "ба бе бо ва ве ви га да де до за зо ка ко ла ле ло ма ме ми на не ни но па по ра ре ри ро са се со та те то".split(),
    "greek": "βα βε γα δα δε ζα κα κε λα λε λο μα με μι να νε νι νο πα πε ρα ρε ρι ρο σα σε σο τα τε το".split(),
}
ENDINGS = {
    "latin": {"f": "na", "m": "rd", "x": "li", "s": "nter"},
    "cyrillic": {"f": "на", "m": "рд", "x": "ли", "s": "нов", "sf": "нова"},
    "greek": {"f": "να", "m": "ρος", "x": "λι", "s": "νης"},
}

_FORMS = "|".join(w for words in ADDRESS.values() for w in words.split())
# A name ends before a possessive s.
_NAME = r"\p{Lu}(?:[\p{L}\p{M}]|['’](?!s(?!\p{L})))+"
# The words for a secret, anywhere in a name such as DB_PASSWORD or secretKey; the last one in a name begins the match, so a name is read once.
_WORDS = r"(?i:password|passwd|passphrase|pwd|token(?!i[sz])|secret(?!ar[iy]|ion|ive|ly)|api[_-]?key|access[_-]?key)"
SECRET = rf"{_WORDS}(?:(?!{_WORDS})[A-Za-z0-9_-])*+[\"']?\s{{0,3}}[=:]\s{{0,3}}[\"']?"
_IP = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}(?![\w]|\.\d)"
# A telephone number ends before an address, and has seven digits or more.
_MORE = rf"(?![ -]{_IP})[ .-]?"
_SEVEN = r"(?<=" + r"\d[ .()-]{0,3}" * 6 + r"\d)"
# How the tokens of common services begin.
_ISSUED = r"(?:eyJ|gh[pousr]_|github_pat_|glpat-|xox[abprs]-|sk-|AIza)"
_GROUP = "[0-9A-Fa-f]{1,4}"
PATTERNS = {
    "email": r"(?<![\w.%+-])[\w.%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+",
    "secret": rf"{SECRET}[A-Za-z0-9+/_.~-]{{6,}}",
    "key": r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b",
    "token": r"(?<![\w-])(?:eyJ[\w-]{8,}\.[\w-]{8,}\.[\w-]+|(?:gh[pousr]_|github_pat_)\w{30,}|glpat-[\w-]{20,}|xox[abprs]-[\w-]{10,}|sk-[\w-]{20,}|AIza[\w-]{35})(?![\w-])",
    "ip6": rf"(?<![\w:.])(?=[A-Fa-f:]*+[0-9])(?:(?:{_GROUP}:){{7}}{_GROUP}|(?={_GROUP}:+{_GROUP}:)(?:{_GROUP}:){{1,6}}(?::{_GROUP}){{1,6}}|(?:{_GROUP}:){{2,7}}:)(?![\w:]|\.\d)",
    "person": rf"(?<!\p{{L}})(?:{_FORMS})\.?\s{{1,3}}{_NAME}(?:[ -]{_NAME}){{0,2}}",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "card": r"(?<![\w.])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?!\w)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "ip": rf"(?<![\w.]){_IP}",
    "phone": rf"(?<![\w+])(?:\+\d{{1,3}}(?:{_MORE}\(\d{{1,4}}\))?(?:{_MORE}\d{{2,5}}){{2,5}}{_SEVEN}|\(\d{{3}}\) ?\d{{3}}[ .-]\d{{4}}|\d{{3}}[.-]\d{{3}}[.-]\d{{4}}|(?<![.,/-])0\d{{2,4}}[ /-]\d{{5,8}}(?![.,-]?\d))(?!\w)",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# What a text must have for any of the patterns to match.
HINT = rf"[0-9@]|(?i:password|passwd|passphrase|pwd|token|secret|key)|(?:{_FORMS})\.?\s"
ATTEMPTS = 64
# What is left after the attempts is placed by rank, from so many choices a value at first.
SPAN, MOST = 4, 10**12

OUTPUT = ("n_entities", "kinds", "surrogates")


def _chars(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)(.)"), F.lit(1))


def kind_of(found: Column) -> Column:
    """Type of a found piece of text."""
    out = F.when(found.contains("@") & ~found.rlike(f"^{SECRET}"), F.lit("email"))
    for kind in ("secret", "key", "token", "ip6", "person", "ip", "ssn", "card", "iban"):
        anchored = rf"^(?:{PATTERNS[kind]})$"
        out = out.when(found.rlike(anchored), F.lit(kind))
    return out.otherwise(F.lit("phone"))


def _value(found: Column) -> Column:
    return F.regexp_replace(found, f"^{SECRET}", "")


def gender_of(found: Column) -> Column:
    form = F.regexp_extract(found, r"^([^\s.]+)", 1)
    return F.when(form.isin(ADDRESS["f"].split()), "f").when(form.isin(ADDRESS["m"].split()), "m").otherwise("x")


def parts_of(found: Column) -> Column:
    """The entities in a found piece as an array of (type, value): one, but for persons one for each name.

    The value has no format: an e-mail address in lower case, the digits of a number.  So the same entity in
    two formats is one, and a surname with and without the given name too.
    """
    kind = kind_of(found)
    compact = F.upper(F.regexp_replace(found, "[^A-Za-z0-9]", ""))
    value = (
        F.when(kind == "email", F.lower(found))
        .when(kind == "secret", _value(found))
        .when(kind == "phone", F.concat(F.regexp_extract(found, r"^\+(\d{1,3})", 1), F.lit("|"), F.regexp_replace(F.regexp_replace(found, r"^\+\d{1,3}", ""), "[^0-9]", "")))
        .when(kind.isin("iban", "card", "ssn"), compact)
        .when(kind == "ip6", F.lower(found))
        .otherwise(found)
    )
    names = F.split(F.regexp_replace(found, r"^\S+\s+", ""), "[ -]")
    given = F.concat(F.lit("given_"), gender_of(found))
    people = F.transform(
        names, lambda n, i: F.struct(F.when(i == F.size(names) - 1, F.lit("surname")).otherwise(given).alias("kind"), F.initcap(n).alias("value"))
    )
    return F.when(kind == "person", people).otherwise(F.array(F.struct(kind.alias("kind"), value.alias("value"))))


def _stream(key: str, kind: Column, value: Column, attempt: Column) -> Column:
    """256 hexadecimal digits that depend on the key, the entity and the attempt."""
    seed = F.concat_ws("\x1f", F.lit(key), kind, value, attempt.cast("string"))
    return F.concat(F.sha2(seed, 512), F.sha2(F.concat(F.lit("+"), seed), 512))


def _number(stream: Column, i: Column | int, below: int) -> Column:
    i = F.lit(i) if isinstance(i, int) else i
    return (F.conv(F.substr(stream, (i % 62) * 4 + 1, F.lit(4)), 16, 10).cast("int") % below).cast("int")


def _same_classes(value: Column, stream: Column) -> Column:
    """Each letter and digit by one of its class; a hexadecimal value stays one."""
    hexadecimal = value.rlike("^(?:[0-9a-f:]+|[0-9A-F:]+)$")
    letters = "abcdefghijklmnopqrstuvwxyz"

    def one(c: Column, i: Column) -> Column:
        pick = F.when(hexadecimal, _number(stream, i, 6)).otherwise(_number(stream, i, 26)) + 1
        low = F.substr(F.lit(letters), pick, F.lit(1))
        return (
            F.when(c.rlike("[0-9]"), _number(stream, i, 10).cast("string")).when(c.rlike("[a-z]"), low).when(c.rlike("[A-Z]"), F.upper(low)).otherwise(c)
        )

    return F.array_join(F.transform(_chars(value), one), "")


def _digits(n: Column, stream: Column) -> Column:
    """``n`` digits, the first not 0 or 1."""
    one = lambda i: F.when(i == 0, _number(stream, i, 8) + 2).otherwise(_number(stream, i, 10)).cast("string")
    return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), n - 1), one), "")).otherwise(F.lit(""))


def _check_digit(body: Column) -> Column:
    """The Luhn digit that completes a number."""
    back = F.reverse(_chars(body))
    doubled = F.transform(back, lambda c, i: F.when(i % 2 == 0, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")))
    total = F.aggregate(doubled, F.lit(0), lambda a, x: a + x)
    return (10 - total % 10) % 10


def _script(value: Column) -> Column:
    return F.when(value.rlike(r"\p{IsCyrillic}"), "cyrillic").when(value.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _ending(kind: Column, value: Column) -> Column:
    # a Slavic surname has a gender of its own
    slavic = (kind == "surname") & (_script(value) == "cyrillic") & value.rlike("[ая]$")
    return F.when(slavic, "sf").when(kind == "surname", "s").otherwise(F.regexp_extract(kind, "_(.)$", 1))


def fake_value(key: str, kind: Column, value: Column, attempt: Column) -> Column:
    """A value of the same type, without format as ``parts_of`` has it."""
    s = _stream(key, kind, value, attempt)
    local, domain = F.substring_index(value, "@", 1), F.substring_index(value, "@", -1)
    d = _stream(key, F.lit("domain"), domain, F.lit(0))
    host = _same_classes(F.substring_index(domain, ".", 1), d)
    email = F.concat(_same_classes(local, s), F.lit("@"), host, F.lit(".example."), F.substring_index(domain, ".", -1))
    country, rest = F.substring_index(value, "|", 1), F.substring_index(value, "|", -1)
    trunk, issuer = F.regexp_extract(rest, "^(0?)", 1), F.regexp_extract(value, f"^({_ISSUED})", 1)
    body = F.concat(F.substring(value, 1, 1), F.substr(_digits(F.length(value), s), F.lit(2), F.length(value) - 2))
    right = _check_digit(body)
    valid = _check_digit(F.substr(value, F.lit(1), F.length(value) - 1)).cast("string") == F.substring(value, -1, 1)
    card = F.concat(body, F.when(valid, right).otherwise((right + 1 + _number(s, 40, 9)) % 10).cast("string"))
    octets = [F.lit(11) + _number(s, 0, 89), *[_number(s, i, 256) for i in (1, 2)], 1 + _number(s, 3, 254)]
    out = (
        F.when(kind == "email", email)
        .when(kind == "phone", F.concat(country, F.lit("|"), trunk, _digits(F.length(rest) - F.length(trunk), s)))
        .when(kind == "card", card)
        .when(kind == "ssn", F.concat(F.lit("9"), _digits(F.lit(8), s)))
        .when(kind == "ip", F.concat_ws(".", *[o.cast("string") for o in octets]))
        .when(kind.isin("key", "iban"), F.concat(F.substring(value, 1, 2), F.when(kind == "key", F.substring(value, 3, 2)).otherwise(F.lit("")),
              _same_classes(F.when(kind == "key", F.substring(value, 5, 1000)).otherwise(F.substring(value, 3, 1000)), s)))
        .when(kind == "token", F.concat(issuer, _same_classes(F.substr(value, F.length(issuer) + 1, F.length(value)), s)))
        .when(kind.isin("secret", "ip6"), _same_classes(value, s))
    )
    script, ending = _script(value), _ending(kind, value)
    for name, syllables in SYLLABLES.items():
        table = F.array(*[F.lit(x) for x in syllables])
        stem = F.concat(*[F.element_at(table, _number(s, i, len(syllables)) + 1) for i in range(4)])
        last = F.element_at(F.create_map(*[F.lit(x) for pair in ENDINGS[name].items() for x in pair]), ending)
        out = out.when(script == name, F.initcap(F.concat(stem, last)))
    return out


def _same_choices(value: Column) -> Column:
    """For each letter and digit those of ``_same_classes``, for others themselves."""
    hexadecimal = value.rlike("^(?:[0-9a-f:]+|[0-9A-F:]+)$")
    low = F.when(hexadecimal, _strings("abcdef")).otherwise(_strings("abcdefghijklmnopqrstuvwxyz"))
    return F.transform(
        _chars(value),
        lambda c: F.when(c.rlike("[0-9]"), _strings("0123456789"))
        .when(c.rlike("[a-z]"), low)
        .when(c.rlike("[A-Z]"), F.transform(low, F.upper))
        .otherwise(F.array(c)),
    )


def _strings(values) -> Column:
    return F.array(*[F.lit(str(x)) for x in values])


def choices(key: str, kind: Column, value: Column, width: Column) -> Column:
    """All surrogates of the format of ``fake_value`` as the choices for each place, with ``width`` places more than it has."""
    digit, lead = _strings(range(10)), F.array(_strings(range(2, 10)))
    one = lambda x: F.array(F.array(x))
    more = F.array_repeat(digit, width)
    domain = F.substring_index(value, "@", -1)
    host = _same_classes(F.substring_index(domain, ".", 1), _stream(key, F.lit("domain"), domain, F.lit(0)))
    at = F.concat(F.lit("@"), host, F.lit(".example."), F.substring_index(domain, ".", -1))
    country, rest = F.substring_index(value, "|", 1), F.substring_index(value, "|", -1)
    trunk, issuer = F.regexp_extract(rest, "^(0?)", 1), F.regexp_extract(value, f"^({_ISSUED})", 1)
    valid = _check_digit(F.substr(value, F.lit(1), F.length(value) - 1)).cast("string") == F.substring(value, -1, 1)
    # the last place of a card is what its check digit is off by
    card = F.concat(one(F.substring(value, 1, 1)), F.array_repeat(digit, F.length(value) - 2), more, F.array(F.when(valid, _strings("0")).otherwise(_strings(range(1, 10)))))
    octet = _strings(f".{i}" for i in range(256))
    narrow = F.array(_strings(range(11, 100)), octet, octet, _strings(f".{i}" for i in range(1, 255)))
    # the whole address space, then places after it
    address = F.when(width == 0, narrow).otherwise(F.concat(F.array(_strings(range(256)), octet, octet, octet), F.array_repeat(octet, width - 1)))
    out = (
        F.when(kind == "email", F.concat(_same_choices(F.substring_index(value, "@", 1)), more, one(at)))
        .when(kind == "phone", F.concat(one(F.concat(country, F.lit("|"), trunk)), lead, F.array_repeat(digit, F.length(rest) - F.length(trunk) - 1), more))
        .when(kind == "card", card)
        .when(kind == "ssn", F.concat(one(F.lit("9")), lead, F.array_repeat(digit, F.lit(7)), more))
        .when(kind == "ip", address)
        .when(kind == "key", F.concat(one(F.substring(value, 1, 4)), _same_choices(F.substring(value, 5, 1000)), more))
        .when(kind == "iban", F.concat(one(F.substring(value, 1, 2)), _same_choices(F.substring(value, 3, 1000)), more))
        .when(kind == "token", F.concat(one(issuer), _same_choices(F.substr(value, F.length(issuer) + 1, F.length(value))), more))
        .when(kind.isin("secret", "ip6"), F.concat(_same_choices(value), more))
    )
    script, ending = _script(value), _ending(kind, value)
    for name, syllables in SYLLABLES.items():
        last = F.element_at(F.create_map(*[F.lit(x) for pair in ENDINGS[name].items() for x in pair]), ending)
        out = out.when(script == name, F.concat(F.array_repeat(_strings(syllables), width + 4), one(last)))
    return out


def chosen(kind: Column, places: Column, number: Column) -> Column:
    """The surrogate of this number, from 0, among those of ``choices``; a bijection up to MOST."""
    start = F.struct(number.cast("long").alias("n"), F.lit("").alias("text"))

    def step(a: Column, c: Column) -> Column:
        i = F.pmod(a["n"], F.size(c).cast("long"))
        return F.struct(((a["n"] - i) / F.size(c)).cast("long").alias("n"), F.concat(a["text"], F.element_at(c, i.cast("int") + 1)).alias("text"))

    text = F.aggregate(places, start, step)["text"]
    body = F.substr(text, F.lit(1), F.length(text) - 1)
    check = (_check_digit(body) + F.substring(text, -1, 1).cast("int")) % 10
    return F.when(kind == "card", F.concat(body, check.cast("string"))).when(kind.rlike("^(?:given_|surname)"), F.initcap(text)).otherwise(text)


def _ranked(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with their rank in their form, by range partitions."""
    rows = running(rows.withColumn("__one", F.lit(1).cast("long")), [F.col("form"), *map(F.col, order)], {"__row": "__one"}, name)
    first = rows.groupBy("form").agg(F.min("__row").alias("__first"))
    return rows.join(first, "form").withColumn("rank", F.col("__row") - F.col("__first")).drop("__one", "__row", "__first")


def placed_by_rank(left: DataFrame, taken: DataFrame, key: str) -> DataFrame:
    """``kind, value, fake`` for the values ``left`` over: the n-th value of a format gets the n-th surrogate of it that is free.

    ``taken`` are the ``space, fake`` that are not free.  The surrogates of a format are counted through from a place that the key
    chooses, as many as its values need; if none at all is free, its values get a place more.  So every value is placed.
    """
    spark = left.sparkSession
    left = left.select("space", "kind", "value", F.lit(0).alias("width"), F.lit(SPAN).cast("long").alias("tries"))
    out = None
    while True:
        formed = left.withColumn("places", choices(key, F.col("kind"), F.col("value"), F.col("width")))
        formed = formed.withColumns({"form": F.sha2(F.concat_ws("\x1f", "kind", F.to_json("places")), 256), "turn": F.sha2(F.concat_ws("\x1f", F.lit(key), "kind", "value"), 256)})
        formed = store(formed, "formed")
        size = F.aggregate("places", F.lit(1).cast("long"), lambda a, c: F.least(a * F.size(c), F.lit(MOST)))
        forms = formed.groupBy("space", "kind", "form").agg(F.count("*").alias("n"), F.max("tries").alias("tries"), F.first("places").alias("places"))
        forms = forms.withColumn("size", size).withColumn("span", F.least("size", F.col("n") * F.col("tries")))
        forms = store(forms.withColumn("start", F.pmod(F.xxhash64(F.lit(key), "form"), F.col("size"))), "forms")
        # numbers in lots of 1,000, so that one format's many are no single row
        lots = forms.withColumn("lot", F.explode(F.sequence(F.lit(0).cast("long"), ((F.col("span") - 1) / 1000).cast("long")))).repartition(partitions(spark))
        last = F.least(F.col("lot") * 1000 + 999, F.col("span") - 1)
        each = lots.withColumn("k", F.explode(F.sequence(F.col("lot") * 1000, last)))
        each = each.select("space", "form", "k", chosen(F.col("kind"), F.col("places"), (F.col("k") + F.col("start")) % F.col("size")).alias("fake"))
        free = store(each.join(taken, ["space", "fake"], "left_anti"), "free")
        # formats may have surrogates in common: each goes to one
        offers = free.groupBy("space", "fake").agg(F.min(F.struct("form", "k")).alias("o")).select("space", "fake", "o.form", "o.k")
        offers, wanted = _ranked(offers, ["k", "fake"], "offers"), _ranked(formed.select("space", "kind", "value", "form", "turn"), ["turn", "kind", "value"], "wanted")
        won = store(wanted.join(offers.select("form", "rank", "fake"), ["form", "rank"]).select("space", "kind", "value", "fake"), "won")
        out = won if out is None else out.unionByName(won)
        some = free.groupBy("form").agg(F.lit(True).alias("some"))
        lost = formed.join(won, ["space", "kind", "value"], "left_anti").select("space", "kind", "value", "width", "form")
        lost = lost.join(forms.select("form", "size", "span", "tries").join(some, "form", "left"), "form")
        full = F.col("span") == F.col("size")
        wider = full & F.col("some").isNull()
        tries = F.when(wider, F.lit(SPAN)).when(full, F.col("tries")).otherwise(F.col("tries") * 4)
        left = store(lost.select("space", "kind", "value", (F.col("width") + wider.cast("int")).alias("width"), tries.cast("long").alias("tries")), "lost")
        if left.isEmpty():
            return out.select("kind", "value", "fake")
        taken = taken.unionByName(won.select("space", "fake"))


def dressed(found: Column, fakes: Column) -> Column:
    """The surrogate values in the format of the found piece."""
    kind, first = kind_of(found), F.element_at(fakes, 1)
    plain = F.regexp_replace(first, r"\|", "")

    def place(c: Column, i: Column) -> Column:
        rank = F.length(F.regexp_replace(F.substr(found, F.lit(1), i + 1), "[^A-Za-z0-9]", ""))
        return F.when(c.rlike("[A-Za-z0-9]"), F.substr(plain, rank, F.lit(1))).otherwise(c)

    # a surrogate wider than the value goes on after it
    wider = F.substr(plain, F.length(F.regexp_replace(found, "[^A-Za-z0-9]", "")) + 1, F.length(plain))
    placed = F.concat(F.array_join(F.transform(_chars(found), place), ""), wider)
    form, called = F.regexp_extract(found, r"^(\S+\s+)", 1), F.regexp_replace(found, r"^\S+\s+", "")
    spoken = F.when(kind == "person", called).otherwise(found)
    loud = (F.upper(spoken) == spoken) & (F.lower(spoken) != spoken)
    gaps = F.regexp_extract_all(called, F.lit("([ -])"), F.lit(1))
    names = F.array_join(F.transform(fakes, lambda n, i: F.concat(n, F.coalesce(F.get(gaps, i), F.lit("")))), "")
    return (
        F.when(kind == "person", F.concat(form, F.when(loud, F.upper(names)).otherwise(names)))
        .when(kind.isin("email", "ip6"), F.when(loud, F.upper(first)).otherwise(first))
        .when(kind == "secret", F.concat(F.regexp_extract(found, f"^({SECRET})", 1), first))
        .when(kind.isin("phone", "card", "ssn", "iban"), placed)
        .otherwise(first)
    )


def collisions(entities: DataFrame, key: str) -> DataFrame | None:
    """``kind, value, fake`` of the entities whose surrogate is not that of attempt 0; None if there are none.

    A surrogate must not be a value of the corpus, nor that of another entity of its type.  In each round the
    smallest value keeps a surrogate that several want; the others try again with the next attempt.
    Only those that collide go into the next round.  When a round leaves more than half of its values, their format is
    crowded, and they are placed by rank.
    """
    fake = lambda attempt: fake_value(key, F.col("kind"), F.col("value"), attempt)
    names = F.when(F.col("kind").startswith("given"), "given").otherwise(F.col("kind"))
    entities = entities.withColumn("space", names)
    pending = store(entities.select("space", "kind", "value", fake(F.lit(0)).alias("fake")), "surrogates")
    real = entities.select("space", F.col("value").alias("fake")).distinct()
    moved, settled, before = None, None, None
    for attempt in range(1, ATTEMPTS + 1):
        # in one space a value has one surrogate for each kind; different values must differ
        first = pending.groupBy("space", "fake").agg(F.min(F.struct("value", "kind")).alias("first"))
        first = first.join(real, ["space", "fake"], "left_anti")
        if settled is not None:
            first = first.join(settled, ["space", "fake"], "left_anti")
        won = first.select("space", "fake", F.col("first.value").alias("value"), F.col("first.kind").alias("kind"))
        if attempt > 1:
            won = store(won, "won")
            moved = won if moved is None else moved.unionByName(won)
        lost = store(pending.join(won, ["space", "fake", "value", "kind"], "left_anti").select("space", "kind", "value"), "lost")
        n = lost.count()
        if not n:
            return None if moved is None else store(moved.select("kind", "value", "fake"), "moved")
        won = won.select("space", "fake")
        settled = store(won if settled is None else settled.union(won), "settled")
        if attempt == ATTEMPTS or before is not None and 2 * n > before:
            break
        before = n
        pending = store(lost.select("space", "kind", "value", fake(F.lit(attempt)).alias("fake")), "surrogates")
    ranked = placed_by_rank(lost, settled.unionByName(real), key)
    return store(ranked if moved is None else moved.select("kind", "value", "fake").unionByName(ranked), "moved")


def names_in(found: Column) -> Column:
    """The words of the names among the found pieces, as written, in capitals and with one capital."""
    people = F.filter(found, lambda f: kind_of(f) == "person")
    words = F.flatten(F.transform(people, lambda f: F.split(F.regexp_replace(f, r"^\S+\s+", ""), "[ -]")))
    return F.array_distinct(F.concat(words, F.transform(words, F.upper), F.transform(words, F.initcap)))


def bare(found: Column) -> Column:
    """Whether a found piece is a name without a form of address."""
    return found.rlike(r"\A[\p{L}\p{M}'’]+\z")


def replace_personal_data(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with surrogates in ``text``, and ``OUTPUT``: the number of entities found, their types, and the surrogates in order.

    Found are e-mail addresses, telephone, card, account (IBAN) and social-security numbers, IPv4 and IPv6 addresses, passwords, keys and the tokens of
    common services, and names after a form of address.  Every word of such a name is then found in the whole of its text, with a form of address or
    without; there a word that is both a given name and a surname, or of both genders, counts as what it is first.  A surrogate depends on
    ``key`` and the entity (after a form of address, given names of another gender are another one); all its mentions get the same one, in the
    format of each, and different entities get different ones (``collisions``).  So it also depends on the other entities where two want the same surrogate: a
    corpus that has grown may give some entities others.  Only where a format has no free ones left they get longer.  Numbers keep length, grouping and country code, a card its
    scheme and the validity of its check digit; names keep the gender that the form of address tells and the script.

    A null text stays null, with no entities; a text without any stays as it is.  Rows equal in doc_id and text get equal results.  An empty table gives
    an empty table; columns named as in ``OUTPUT`` are replaced.
    """
    docs = without(docs, *OUTPUT)
    none = F.array().cast("array<string>")
    spotted = F.when(F.col("text").rlike(HINT), F.regexp_extract_all("text", F.lit(f"({ANY})"), F.lit(1))).otherwise(none)
    print_ = F.xxhash64(F.coalesce("text", F.lit("")))
    light = docs.select("doc_id", print_.alias("print"), F.coalesce(spotted, none).alias("found")).filter("size(found) > 0")
    mentions = light.select("doc_id", "print", F.explode(F.array_distinct("found")).alias("found"))
    mentions = store(mentions.select("doc_id", "print", F.explode(parts_of(F.col("found"))).alias("e")).select("doc_id", "print", "e.*"), "mentions")
    entities = store(mentions.groupBy("kind", "value").agg(F.count("*").alias("n")).select("kind", "value"), "entities")
    moved = collisions(entities, key)

    rows = docs.withColumn("__first", F.coalesce(spotted, none))
    # a second look at the texts with names, with a pattern of their own
    rows = rows.withColumn("__names", F.when(F.exists("__first", lambda f: kind_of(f) == "person"), names_in(F.col("__first"))).otherwise(none))
    named = F.size("__names") > 0
    again_ = F.concat(F.lit(f"{ANY}|(?<![\\p{{L}}\\p{{M}}\\p{{N}}_'’])(?:"), F.array_join("__names", "|"), F.lit(r")(?![\p{L}\p{M}\p{N}_])"))
    found_again = F.regexp_extract_all("text", F.concat(F.lit("("), again_, F.lit(")")), F.lit(1))
    rows = rows.withColumn("__found", F.when(named, found_again).otherwise(F.col("__first")))
    # the entity of each word of a name: the first that it is part of
    people = F.flatten(F.transform(F.filter("__first", lambda f: kind_of(f) == "person"), parts_of))
    rows = rows.withColumn("__people", F.when(named, people).otherwise(F.array().cast("array<struct<kind:string,value:string>>")))
    if moved is None:
        rows = rows.withColumn("__moved", F.lit(None).cast("map<string,string>"))
    else:
        # documents that mention an entity whose surrogate is not its first; a group holds one document's entities
        again = mentions.join(broadcast_if_small(moved), ["kind", "value"]).distinct()
        name = F.concat_ws("\x1f", "kind", "value")
        again = again.groupBy("doc_id", "print").agg(F.map_from_entries(F.collect_set(F.struct(name, F.col("fake")))).alias("__moved"))
        again = broadcast_if_small(store(again.withColumnsRenamed({"doc_id": "__of", "print": "__by"}), "again"))
        rows = rows.join(again, F.col("doc_id").eqNullSafe(F.col("__of")) & (print_ == F.col("__by")), "left")

    def surrogate(found: Column) -> Column:
        def fake(e: Column) -> Column:
            other = F.get(F.map_values(F.map_filter("__moved", lambda k, _: k == F.concat_ws("\x1f", e["kind"], e["value"]))), 0)
            return F.coalesce(other, fake_value(key, e["kind"], e["value"], F.lit(0)))

        def of_name(word: Column) -> Column:
            return fake(F.get(F.filter("__people", lambda e: e["value"] == F.initcap(word)), 0))

        whole = dressed(found, F.transform(parts_of(found), fake))
        loud = F.upper(found) == found
        return F.when(bare(found), F.when(loud, F.upper(of_name(found))).otherwise(of_name(found))).otherwise(whole)

    some = F.size("__found") > 0
    rows = rows.withColumns(
        {
            "__new": F.when(some, F.transform("__found", surrogate)).otherwise(none),
            "__kinds": F.when(some, F.transform("__found", lambda f: F.when(bare(f), "person").otherwise(kind_of(f)))).otherwise(none),
        }
    )
    between = F.when(named, F.split("text", again_, -1)).otherwise(F.split("text", ANY, -1))
    text = F.array_join(F.zip_with(between, F.col("__new"), lambda b, s: F.concat(b, F.coalesce(s, F.lit("")))), "")
    text = F.when(some, text).otherwise(F.col("text"))
    columns = [text.alias(c) if c.lower() == "text" else F.col(f"`{c}`") for c in docs.columns]
    return rows.select(*columns, F.size("__found").alias("n_entities"), F.col("__kinds").alias("kinds"), F.col("__new").alias("surrogates"))


