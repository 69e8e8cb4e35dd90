"""Personal data: every detected entity gets a keyed surrogate of its own kind. DataFrame functions only.

Entities are found by pattern, brought into one canonical spelling, and mapped over the whole corpus: one
surrogate for each (kind, canonical value), so the same person or number has the same surrogate everywhere. A
surrogate that equals an original of the corpus, or another entity's surrogate, is drawn again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pathweave.functions.columns import bind, named, once
from pathweave.llm.scratch import dropped, written

# Titles that tell a person's name and gender.
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Señorita", "Госпожа", "Κυρία")
MALE_TITLES = ("Mr", "Mister", "Herr", "Monsieur", "Señor", "Господин", "Κύριος")
NEUTRAL_TITLES = ("Dr", "Prof", "Professor", "Mx")
_TITLES = "(?:" + "|".join(FEMALE_TITLES + MALE_TITLES + NEUTRAL_TITLES) + ")"
# Words in lower case that stand before or within a surname.
_PARTICLES = r"(?:(?:von|vom|van|de|der|den|del|della|di|da|dos|du|la|le|zu|zum|zur|und|bin|ibn|al|el|af|av|ten|ter) ){0,3}"

_WORD_END = r"(?![\p{L}\p{N}])"
# A name: a capital, then letters, and apostrophes and hyphens between letters; the 's of a possessive is not part of it.
_TOKEN = r"\p{Lu}(?:[\p{L}\p{M}]|['’](?!s(?!\p{L}))(?=\p{L})|-(?=\p{L})){1,200}"
_BARE = r"(?<![\p{L}\p{N}])" + _TOKEN + r"(?![\p{L}\p{N}])"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
# What may stand between the digits of a phone number, and between those beyond the eighth, where a sentence may end.
_GAP = r"[^\p{L}\p{N}\n+]{0,8}"
_LATE_GAP = r"(?:(?![,;:!?|]|\.\s)[^\p{L}\p{N}\n+]){0,8}"
_SHORT_GAP = r"[^\p{L}\p{N}\n]{1,8}"
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}][\p{L}\p{N}._%+'-]{0,63}@(?:[\p{L}\p{N}-]{1,63}\.){1,126}\p{L}{2,63}" + _WORD_END,
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?" + _WORD_END,
    "secret": r"(?<![\p{L}\p{N}])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)" + _WORD_END,
    "key": r"(?<![\p{L}\p{N}])(?:AKIA[0-9A-Z]{16}|sk-[A-Za-z0-9]{20,}+|gh[pousr]_[A-Za-z0-9]{30,}+)" + _WORD_END,
    "phone": r"(?<![\p{L}\p{N}])\+\d(?:" + _GAP + r"\d){7}(?:" + _LATE_GAP + r"\d){0,7}(?!\d)"
             r"|(?<![\p{L}\p{N}])\+\d{1,3}" + _SHORT_GAP + r"\d{2,4}(?:" + _SHORT_GAP + r"\d{2,4}){1,4}(?!\d)"
             r"|(?<![\p{L}\p{N}])(?:\(\d{3}\)[ .-]?|\d{3}[-.])\d{3}[-.]\d{4}(?!\d)"
             r"|(?<![\p{L}\p{N}])(?:\(\d{3}\) ?|[2-9]\d{2} )[2-9]\d{2} \d{4}(?![\p{L}\p{N}])",
    "card": r"(?<![\p{L}\p{N}.])(?:\d{4}[ -]?){3}\d{4}(?!\d)|(?<![\p{L}\p{N}.])\d{4}[ -]?\d{6}[ -]?\d{5}(?!\d)",
    "ssn": r"(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "ip": r"(?<![\p{L}\p{N}.])(?:" + _OCTET + r"\.){3}" + _OCTET + r"(?!\d|\.\d)",
    "name": r"(?<!\p{L})(?:" + _TITLES + r"\.? ){1,3}(?:\p{Lu}\. ?){0,3}" + _PARTICLES + _TOKEN + r"(?: (?:\p{Lu}\. )?" + _PARTICLES + _TOKEN + r"){0,2}(?!\p{L})",
}
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS.values())
# What every match contains or begins with; quick to look for, and rare.
_SIGNS = (
    r"[@+0-9]|(?=[" + "".join(sorted({t[0] for t in FEMALE_TITLES + MALE_TITLES + NEUTRAL_TITLES})) + r"Asg])(?:(?<!\p{L})"
    + _TITLES + r"\.? |AKIA|sk-|gh[pousr]_)|[a-fA-F]{32}"
)
_TITLE = r"^(?:" + _TITLES + r"\.? ){1,3}"

# Syllables that names are made of, by script.
_HEADS = {"latin": "Al Ber Cor Dan Ed Fer Gus Hen Iv Jor Kar Leo Mar Nor Os Pet Rob Ste Tom Vic", "cyrillic": "Ал Бор Вас Гри Дан Ев Жан Зах Ив Кар Лев Мар Ник Ол Пав Род Сер Тим Фед Яр", "greek": "Αλ Βασ Γιω Δη Ελ Θεο Ιω Κων Λε Μαρ Νικ Ορ Παν Σωτ Φιλ"}
_MIDS = {"latin": "ba de fi go la me ni ro ta ve", "cyrillic": "ба де ви го ла ме ни ро та ве", "greek": "βα δε γι λο μα νε πι ρο τα φε"}
_TAILS = {
    "given_m": {"latin": "an bert do fred kus ren rik ton us win", "cyrillic": "ан ий ил им ир ислав ор рен тон ур", "greek": "ας ης ιος ος ων"},
    "given_f": {"latin": "a ana bella ella ia ina lotte na ra sa", "cyrillic": "а ана елла ина ия лина на рина та яна", "greek": "α εια ινα ουλα ω"},
    "surname": {"latin": "berg dale feld ford hart lund man ner son stein well wood", "cyrillic": "енко ский ук як ян", "greek": "ακης ιδης ογλου πουλος"},
}
_LETTERS = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзиклмнопрстуфхцчшщэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}
#: From this draw on a surrogate may leave the format of its original, so that a draw that is free is always found.
_FREE = 8


def _kind(value: Column) -> Column:
    """Kind of a match: the first pattern that matches all of it (context aside)."""
    bare = {k: p.replace("(?<![\\p{L}\\p{N}._%+-])", "") for k, p in PATTERNS.items()}
    return reduce(lambda out, k: F.when(value.rlike(f"^(?:{bare[k]})$"), k).otherwise(out), list(PATTERNS)[-2::-1], F.lit("name"))


def _alnum(value: Column) -> Column:
    return F.regexp_replace(value, r"[^\p{L}\p{N}]", "")


def _script(value: Column) -> Column:
    return F.when(value.rlike(r"\p{IsCyrillic}"), "cyrillic").when(value.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _byte(stream: Column, i: Column) -> Column:
    """The i-th of the keyed stream's 128 bytes."""
    return F.conv(F.substring(stream, (i * 2) % 256 + 1, F.lit(2)), 16, 10).cast("int")


def _pick(words: str, byte: Column) -> Column:
    listed = F.split(F.lit(words), " ")
    return F.get(listed, byte % F.size(listed))


def _letter(c: Column, byte: Column) -> Column:
    out = F.lit(_LETTERS["latin"])
    out = F.when(_script(c) == "cyrillic", _LETTERS["cyrillic"]).when(_script(c) == "greek", _LETTERS["greek"]).otherwise(out)
    return F.substring(out, byte % F.length(out) + 1, F.lit(1))


def _redrawn(value: Column, stream: Column, fixed: Column) -> Column:
    """Each letter and digit from position ``fixed`` on replaced by one of its own kind; all else stays."""
    def char(c: Column, i: Column) -> Column:
        byte = _byte(stream, i)
        new = F.when(c.rlike(r"\p{N}"), (byte % 10).cast("string")).when(c.rlike(r"\p{L}"), _letter(c, byte)).otherwise(c)
        return F.when(i < fixed, c).otherwise(new)

    return F.array_join(F.transform(F.split(value, ""), char), "")


def _luhn(digits: Column) -> Column:
    """Luhn sum of a string of digits, read from the right."""
    def add(total: Column, pair: Column) -> Column:
        d, odd = pair["d"].cast("int"), pair["i"] % 2 == 1
        twice = F.when(odd, d * 2).otherwise(d)
        return total + F.when(twice > 9, twice - 9).otherwise(twice)

    chars = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.struct(c.alias("d"), i.alias("i")))
    return F.aggregate(chars, F.lit(0), add)


def _card(value: Column, stream: Column) -> Column:
    """Digits after the first redrawn; the last one keeps the checksum of a number that has a right one."""
    new = _redrawn(value, stream, F.lit(1))
    body = F.substring(new, F.lit(1), F.length(new) - 1)
    last = ((10 - _luhn(F.concat(body, F.lit("0"))) % 10) % 10).cast("string")
    return F.when(_luhn(value) % 10 == 0, F.concat(body, last)).otherwise(new)


def _octets(value: Column, stream: Column) -> Column:
    def octet(o: Column, i: Column) -> Column:
        byte = _byte(stream, i)
        return F.when(F.length(o) == 1, byte % 10).when(F.length(o) == 2, 10 + byte % 90).otherwise(100 + byte % 156).cast("string")

    return F.array_join(F.transform(F.split(value, r"\."), octet), ".")


def _hex(value: Column, stream: Column) -> Column:
    return F.array_join(F.transform(F.split(value, ""), lambda c, i: F.lower(F.hex((_byte(stream, i) % 16).cast("long")))), "")


def _name(kind: str, value: Column, stream: Column, draw: Column) -> Column:
    """A name of the same script; each draw has a syllable more than the last, so that there are always enough."""
    def of(script: str) -> Column:
        mids = F.transform(F.sequence(F.lit(0), draw), lambda i: _pick(_MIDS[script], _byte(stream, i + 3)))
        return F.concat(_pick(_HEADS[script], _byte(stream, F.lit(0))), F.array_join(mids, ""), _pick(_TAILS[kind][script], _byte(stream, F.lit(1))))

    script = _script(value)
    return F.lower(F.when(script == "cyrillic", of("cyrillic")).when(script == "greek", of("greek")).otherwise(of("latin")))


def _surrogate(kind: Column, value: Column, draw: Column, key: str) -> Column:
    """Canonical surrogate of a canonical value, from the key, the value and the number of the draw."""
    def block(n: int) -> Column:
        return F.sha2(F.concat_ws("\x1f", F.lit(key), kind, value, draw.cast("string"), F.lit(str(n))), 256)

    def drawn(stream: Column) -> Column:
        domain = F.substring_index(value, ".", -1)
        email = F.concat(_redrawn(F.substring(value, F.lit(1), F.length(value) - F.length(domain)), stream, F.lit(0)), domain)
        free = F.concat(F.lit("x"), F.substring(stream, F.lit(1), F.lit(24)))
        number = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(17)), lambda i: (_byte(stream, i) % 10).cast("string")), "")
        out = F.when(kind == "email", F.when(draw < _FREE, email).otherwise(F.concat(free, F.lit("@example.com"))))
        for name in _TAILS:
            out = out.when(kind == name, _name(name, value, stream, draw))
        out = out.when(kind.isin("secret", "key") & (draw >= _FREE), free).when(draw >= _FREE, number)
        return (
            out.when(kind == "card", _card(value, stream)).when(kind == "ip", _octets(value, stream))
            .when(kind == "secret", _hex(value, stream)).when(kind == "iban", _redrawn(value, stream, F.lit(2)))
            .when(kind == "phone", _redrawn(value, stream, F.when(F.length(value) > 10, F.length(value) - 10).otherwise(0)))
            .otherwise(_redrawn(value, stream, F.lit(0)))
        )

    return bind(F.concat(*[block(n) for n in range(4)]), drawn)


def _in_format(value: Column, surrogate: Column) -> Column:
    """The surrogate's letters and digits in the punctuation and case of the value, if there are as many."""
    def fill(new: Column) -> Column:
        def char(c: Column, i: Column) -> Column:
            at = F.length(_alnum(F.substring(value, F.lit(1), i + 1)))
            s = F.substring(new, at, F.lit(1))
            return F.when(~c.rlike(r"[\p{L}\p{N}]"), c).when(c.rlike(r"\p{Lu}"), F.upper(s)).otherwise(s)

        same = F.length(new) == F.length(_alnum(value))
        return F.when(same, F.array_join(F.transform(F.split(value, ""), char), "")).otherwise(surrogate)

    return bind(_alnum(surrogate), fill)


def _parts(value: Column) -> Column:
    """Parts of a match: a literal has no kind; a name gives its title and its tokens, all else is one entity."""
    def part(kind: Column, canonical: Column, raw: Column) -> Column:
        return F.struct(kind.cast("string").alias("kind"), canonical.alias("canonical"), raw.alias("raw"))

    title = F.regexp_extract(value, _TITLE, 0)
    tokens = F.split(F.regexp_replace(value, _TITLE, ""), " ")
    given = F.when(F.regexp_extract(title, r"^\p{L}+", 0).isin(*FEMALE_TITLES), "given_f").otherwise("given_m")
    # a particle stays as it is: a part without a kind
    names = F.transform(tokens, lambda t, i: part(F.when(t.rlike(r"^\p{Lu}"), F.when(i < F.size(tokens) - 1, given).otherwise("surname")), F.lower(t), t))

    def of(kind: Column) -> Column:
        canonical = F.when(kind.isin("email", "secret"), F.lower(value)).when(kind.isin("ip", "key"), value).otherwise(_alnum(value))
        return F.when(kind == "name", F.concat(F.array(part(F.lit(None), F.lit(None).cast("string"), title)), names)).otherwise(F.array(part(kind, canonical, value)))

    return bind(_kind(value), of)


def _untitled(between: Column, names: Column) -> Column:
    """Parts of the text between matches, with the number of names in them: those in ``names`` (lower case, surrogate) are replaced."""
    def part(text: Column) -> Column:
        def known(word: Column) -> Column:
            return F.get(F.filter(names, lambda n: n["name"] == F.lower(word)), F.lit(0))["out"]

        def joined(found: Column) -> Column:
            whole = F.zip_with(F.split(text, _BARE, -1), F.zip_with(found, F.regexp_extract_all(text, F.lit(_BARE), 0), lambda new, word: F.coalesce(new, word)),
                               lambda gap, word: F.concat(gap, F.coalesce(word, F.lit(""))))
            return F.struct(F.array_join(whole, "").alias("text"), F.size(F.filter(found, F.isnotnull)).alias("n"))

        return F.when(F.size(names) > 0, bind(F.transform(F.regexp_extract_all(text, F.lit(_BARE), 0), known), joined)).otherwise(
            F.struct(text.alias("text"), F.lit(0).alias("n")))

    return F.transform(between, part)


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``kind, canonical, surrogate`` for distinct ``kind, canonical``: one to one, and never an original of the corpus."""
    todo, settled = entities.withColumn("draw", F.lit(0)), None
    while True:
        drawn = written(todo.withColumn("surrogate", _surrogate(F.col("kind"), F.col("canonical"), F.col("draw"), key)), "drawn")
        originals = entities.select("kind", F.col("canonical").alias("surrogate"))
        taken = originals if settled is None else originals.union(settled.select("kind", "surrogate"))
        first = drawn.groupBy("kind", "surrogate").agg(F.min("canonical").alias("canonical"))
        good = first.join(taken, ["kind", "surrogate"], "left_anti").select("kind", "canonical", "surrogate")
        new = written(good if settled is None else good.union(settled), "surrogates")
        left = written(drawn.join(new, ["kind", "canonical"], "left_anti").select("kind", "canonical", F.col("draw") + 1), "collided")
        dropped(drawn)
        if settled is not None:
            dropped(settled)
        todo, settled = left.toDF("kind", "canonical", "draw"), new
        if left.isEmpty():
            return settled


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with surrogates in ``text``, and with ``n_chars, n_replaced, kinds`` (sorted, distinct).

    A surrogate keeps kind, script, letter case, punctuation and length of its original (names: gender, from the title,
    script and capital; a name found by its title is replaced in the rest of its document too); cards keep a right checksum, addresses valid octets. Spellings of one number or address
    that differ in case or punctuation are one entity. The same key gives the same surrogates for the same corpus.

    Only texts with an entity are shuffled. A null text counts as empty and becomes empty; a null id is an id like any other;
    rows that repeat id and text become the same text. Extra columns pass through, those named like the ones set
    here are replaced. An empty table gives no rows.
    """
    own = ("text", "n_chars", "n_replaced", "kinds", "_hash", "_hit", "_between", "_new", "_names", "_id", "_of")
    kept = [c for c in docs.columns if c not in own]
    base = docs.select(*[named(c) for c in kept], F.coalesce("text", F.lit("")).alias("text"))
    marked = once(base, _hit=F.when(F.col("text").rlike(_SIGNS), F.col("text").rlike(PATTERN)).otherwise(False))
    hits = marked.filter("_hit").drop("_hit").withColumn("_hash", F.xxhash64("doc_id", "text"))
    found = hits.select("doc_id", "_hash", "text").dropDuplicates(["doc_id", "_hash"])
    matches = found.select("doc_id", "_hash", F.posexplode(F.regexp_extract_all("text", F.lit(PATTERN), 0)).alias("pos", "value"))
    split = matches.select("doc_id", "_hash", "pos", F.posexplode(_parts(F.col("value"))).alias("part", "p"))
    parts = written(split.select("doc_id", "_hash", "pos", "part", "p.*"), "entities")
    mapping = surrogates(parts.filter("kind is not null").select("kind", "canonical").distinct(), key)
    joined = parts.join(mapping, ["kind", "canonical"], "left")
    is_name = F.col("kind").isin(*_TAILS)
    out = F.when(F.col("kind").isNull(), F.col("raw")).when(is_name, F.initcap("surrogate")).otherwise(_in_format(F.col("raw"), F.col("surrogate")))
    whole = joined.withColumn("out", out).groupBy("doc_id", "_hash", "pos").agg(
        F.sort_array(F.collect_list(F.struct("part", "out"))).alias("outs"),
        F.max(F.when(is_name, "name").otherwise(F.col("kind"))).alias("kind"),
        F.collect_set(F.when(is_name & ~F.col("canonical").endswith("."), F.struct(
            F.col("canonical").alias("name"), (F.col("kind") != "surname").alias("given"), "out"))).alias("names"),
    ).withColumn("outs", F.transform("outs", lambda o: o["out"]))
    name = F.concat(F.get("outs", F.lit(0)), F.array_join(F.slice("outs", F.lit(2), F.greatest(F.size("outs") - 1, F.lit(0))), " "))
    by_doc = whole.withColumn("new", name).groupBy("doc_id", "_hash").agg(
        F.sort_array(F.collect_list(F.struct("pos", "new"))).alias("_new"), F.sort_array(F.collect_set("kind")).alias("kinds"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("names")))).alias("_names"),
    ).withColumnsRenamed({"doc_id": "_id", "_hash": "_of"})
    same = hits["doc_id"].eqNullSafe(by_doc["_id"]) & (hits["_hash"] == by_doc["_of"])
    linked = hits.join(by_doc.hint("shuffle_hash"), same, "left")
    linked = once(linked, _between=_untitled(F.split("text", PATTERN, -1), F.col("_names")))
    text = F.array_join(F.zip_with("_between", "_new", lambda b, n: F.concat(b["text"], F.coalesce(n["new"], F.lit("")))), "")
    more = F.aggregate("_between", F.lit(0), lambda total, b: total + b["n"])
    done = linked.select(*[named(c) for c in kept], text.alias("text"), (F.size("_new") + more).cast("long").alias("n_replaced"), "kinds")
    clean = marked.filter(~F.col("_hit")).select(
        *[named(c) for c in kept], "text", F.lit(0).cast("long").alias("n_replaced"), F.array().cast("array<string>").alias("kinds")
    )
    every = done.unionByName(clean)
    return every.withColumn("n_chars", F.length("text").cast("long"))
