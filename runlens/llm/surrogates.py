"""Personal data replaced by keyed surrogates of the same type, DataFrame functions only.

One pattern finds the entities of a text. The surrogate of an entity follows from a
secret key, its type and its canonical form, so that all mentions of it, in all
documents and spellings, get the same one. It keeps the format: digits stay digits,
letters keep their case, script and whether they are vowels, marks stay; card numbers
stay valid, addresses stay addresses, given names keep their gender and script.

Distinct entities must get distinct surrogates, and no surrogate may be an entity that
occurs. Both are checked over all entities of the corpus, and where they fail an entity
takes its next surrogate until none does.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runlens.llm.shared import stored

# Rounds of new surrogates before giving up; each round leaves a small share of the last.
ROUNDS = 50

# Common given names by gender and script.
GIVEN = {
    "female latin": "Alice Anna Barbara Carmen Caroline Charlotte Claire Elena Elizabeth Emily Emma Eva Hannah "
    "Helen Isabel Jane Jennifer Jessica Julia Karen Laura Linda Lisa Lucia Maria Marie Mary Michelle Nancy Nicole "
    "Olivia Patricia Rachel Rebecca Sandra Sarah Sofia Sophie Susan Teresa",
    "male latin": "Adam Albert Alexander Andrew Anthony Antonio Benjamin Carlos Charles Christopher Daniel David "
    "Edward Eric Francisco Frank George Hans Henry Jacques James Jason John Joseph Juan Kevin Louis Luis Michael "
    "Miguel Nicolas Oliver Paul Pedro Peter Pierre Richard Robert Thomas William",
    "female cyrillic": "Анна Виктория Галина Дарья Екатерина Елена Ирина Мария Наталья Ольга Светлана Татьяна",
    "male cyrillic": "Алексей Андрей Борис Виктор Владимир Дмитрий Иван Михаил Николай Павел Сергей Юрий",
}

_BEFORE, _AFTER = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
_SECRET = r"(?i:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)\s{0,2}[=:]\s{0,2}[\"']?"


def _any_of(words: list[str]) -> str:
    """A pattern for any of some words, which shares their beginnings, so that most fail at the first letter."""
    rests: dict[str, list[str]] = {}
    for word in words:
        rests.setdefault(word[:1], []).append(word[1:])
    # Longer words go first; the empty rest comes last.
    found = [first + _any_of(rest) if first else "" for first, rest in sorted(rests.items(), reverse=True)]
    return found[0] if len(found) == 1 else "(?:" + "|".join(found) + ")"


_NAMES = _any_of(sorted({x for names in GIVEN.values() for x in names.split()}))

#: Types in the order in which they are tried: a pattern, and what of it is replaced.
TYPES = {
    "secret": _BEFORE + _SECRET + r"(?=[^\s\"'<>,;]*\d)[^\s\"'<>,;]{6,}",
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}+@(?:[\p{L}\p{N}-]{1,63}\.){1,8}[\p{L}]{2,24}" + _AFTER,
    "key": _BEFORE + r"(?:AKIA|ASIA)[A-Z0-9]{16}" + _AFTER,
    "ip": r"(?<![\p{L}\p{N}._])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\p{L}\p{N}_]|\.\d)",
    "card": r"(?<![\p{L}\p{N}_-])[3-6]\d{3}(?:\d{9,15}|[ -]\d{4}[ -]\d{4}[ -]\d{4}|[ -]\d{6}[ -]\d{5})(?![\p{L}\p{N}_-])",
    "ssn": r"(?<![\p{L}\p{N}_-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}_-])",
    "phone": r"(?<![\p{L}\p{N}_+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}"
    r"|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\p{L}\p{N}_]|-\d)",
    "name": r"(?<!\p{L})(?:" + _NAMES + r")\s\p{Lu}[\p{Ll}'-]{1,24}(?!\p{L})",
}

# What the first character of some types is; the others are tried wherever no letter stands before.
_FIRST = {"secret": "[aApPsStT]", "key": "A", "name": r"\p{Lu}"} | dict.fromkeys(["ip", "card", "ssn", "phone"], r"[\d+(]")


def _gated(kinds: list[str]) -> str:
    """Any of the types in their order; neighbours with the same first characters are tried behind one look at them."""
    out = []
    for first, group in groupby(kinds, _FIRST.get):
        some = "|".join(f"(?:{TYPES[x]})" for x in group)
        out.append(f"(?={first})(?:{some})" if first else some)
    return "|".join(out)


# No type begins with white space or behind a letter, so nearly all places are left after two looks.
PATTERN = rf"(?=\S)(?<!\p{{L}})(?:{_gated(list(TYPES))})"


def _given(key: str) -> dict[str, str]:
    """Each given name's surrogate: the next one of its list in keyed order, so none meet."""
    out = {}
    for names in GIVEN.values():
        order = sorted(names.split(), key=lambda x: hashlib.sha256(f"{key}|{x}".encode()).digest())
        out.update(zip(order, [*order[1:], order[0]], strict=True))
    return out


def _literals(values: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for pair in values.items() for x in pair))


def _is(kind: str, entity: Column) -> Column:
    return entity.rlike(f"^(?:{TYPES[kind]})$")


def _kind(entity: Column) -> Column:
    """The type of an entity that stands alone."""
    found = F.lit("lone")
    for kind in reversed(TYPES):
        found = F.when(_is(kind, entity), F.lit(kind)).otherwise(found)
    return found


def _parts(entity: Column) -> Column:
    """An entity as (type, text before, what is replaced) in order: two for names, else one."""
    part = lambda kind, before, core: F.struct(
        kind.alias("kind"), before.alias("before"), core.alias("core")
    )
    kind, none = _kind(entity), F.lit("")
    head = F.regexp_extract(entity, "^" + _SECRET, 0)
    words = F.split(entity, r"\s")
    given = F.element_at(words, 1)
    surname = F.element_at(words, -1)
    gap = F.substr(entity, F.length(given) + 1, F.lit(1))
    return (
        F.when(kind == "name", F.array(part(F.lit("given"), none, given), part(F.lit("surname"), gap, surname)))
        .when(kind == "secret", F.array(part(kind, head, F.substr(entity, F.length(head) + 1, F.length(entity)))))
        .when((kind == "lone") & entity.rlike(f"^(?:{_NAMES})$"), F.array(part(F.lit("given"), none, entity)))
        .when(kind == "lone", F.array(part(F.lit("surname"), none, entity)))
        .otherwise(F.array(part(kind, none, entity)))
    )


def _canonical(kind: Column, core: Column) -> Column:
    """What all spellings of an entity share."""
    plain = F.lower(F.regexp_replace(core, r"[^\p{L}\p{N}]", ""))
    return F.when(kind.isin("card", "ssn", "phone"), plain).when(kind.isin("email", "surname"), F.lower(core)).otherwise(core)


# Letters are replaced within these: vowels and consonants of a script.
_ALPHABETS = ["aeiou", "bcdfghjklmnpqrstvwxyz", "аеиоуыэюя", "бвгджзклмнпрстфхцчш", "αεηιουω", "βγδζθκλμνξπρστφχψ"]


def _mapped(kind: Column, core: Column, canonical: Column, key: str, attempt: Column) -> Column:
    """The core's characters, each replaced within its class as the keyed hash says."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), kind, attempt.cast("string"), canonical), 512)
    hexadecimal = (kind == "secret") & core.rlike("^[0-9a-f]+$")
    tail = F.length(core) - F.length(F.regexp_extract(core, r"\.[\p{L}]+$", 0))

    def one(c: Column, i: Column) -> Column:
        """The character for the place among letters and digits, so marks don't matter."""
        before = F.regexp_replace(F.substr(core, F.lit(1), i), r"[^\p{L}\p{N}]", "")
        at = F.length(before) % 64
        number = F.conv(F.substr(digest, at * 2 + 1, F.lit(2)), 16, 10).cast("int")
        # Beyond 64 characters the same bytes serve again, moved by the place.
        number = number + F.floor(F.length(before) / 64).cast("int") * 7
        pick = lambda letters: F.substr(F.lit(letters), number % len(letters) + 1, F.lit(1))
        low = F.lower(c)
        letter = low
        for letters in _ALPHABETS:
            letter = F.when(F.lit(letters).contains(low), pick(letters)).otherwise(letter)
        # Letters of other scripts and with accents: some letter of the basic alphabet.
        other = ~F.lit("".join(_ALPHABETS)).contains(low) & c.rlike(r"^\p{L}$")
        letter = F.when(other, pick(_ALPHABETS[1])).otherwise(letter)
        cased = F.when(c != low, F.upper(letter)).otherwise(letter)
        return (
            F.when(hexadecimal, pick("0123456789abcdef"))
            .when(c.rlike("^[0-9]$"), F.when((kind == "phone") & (at == 0), c).otherwise(pick("0123456789")))
            .when((kind == "email") & (i >= tail), c)
            .when((kind == "key") & (i < 4), c)
            .when((kind == "key"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"))
            .otherwise(cased)
        )

    text = F.array_join(F.transform(F.split(core, ""), one), "")
    octet = lambda i: F.conv(F.substr(digest, F.lit(2 * i + 1), F.lit(2)), 16, 10).cast("int") % 254 + 1
    address = F.concat_ws(".", *(octet(i).cast("string") for i in range(4)))
    return F.when(kind == "ip", address).when(kind == "card", _valid_card(core, text)).otherwise(text)


def _digits(text: Column) -> Column:
    return F.transform(F.split(F.regexp_replace(text, "[^0-9]", ""), ""), lambda x: x.cast("int"))


def _luhn(digits: Column) -> Column:
    """The checksum of card numbers over digits, the last one first."""
    doubled = F.transform(
        F.reverse(digits),
        lambda d, i: F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2),
    )
    return F.aggregate(doubled, F.lit(0), lambda s, d: s + d) % 10


def _valid_card(core: Column, mapped: Column) -> Column:
    """The mapped number with the first digit kept and its last one making it valid; others stay."""
    first = F.concat(F.substr(core, F.lit(1), F.lit(1)), F.substr(mapped, F.lit(2), F.length(mapped)))
    body = F.substr(first, F.lit(1), F.length(first) - 1)
    check = (10 - _luhn(F.concat(_digits(body), F.array(F.lit(0))))) % 10
    return F.when(_luhn(_digits(core)) == 0, F.concat(body, check.cast("string"))).otherwise(core)


def _lone_pattern(names: Column) -> Column:
    """The pattern, and the parts of the text's own full names where they stand alone."""
    parts = F.array_distinct(F.flatten(F.transform(names, lambda x: F.split(x, r"\s"))))
    quoted = F.transform(parts, lambda x: F.concat(F.lit(r"\Q"), x, F.lit(r"\E")))
    own = F.concat(F.lit(PATTERN + r"|(?<!\p{L})(?:"), F.array_join(quoted, "|"), F.lit(r")(?!\p{L})"))
    return F.when(F.size(names) > 0, own).otherwise(F.lit(PATTERN))


def _found(docs: DataFrame, text: Column) -> DataFrame:
    """`docs` with the pattern for each text and what it finds there."""
    quick = text.rlike(PATTERN)
    names = F.filter(F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)), lambda x: _is("name", x))
    some = docs.withColumn(_PATTERN, F.when(quick, _lone_pattern(names)))
    entities = F.when(F.col(_PATTERN).isNotNull(), F.regexp_extract_all(text, F.col(_PATTERN), F.lit(0)))
    return some.withColumn(_ENTITIES, entities)


_PATTERN, _ENTITIES, _LATER = "surrogates__pattern", "surrogates__entities", "surrogates__later"


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def _attempts(parts: DataFrame, key: str) -> DataFrame:
    """(kind, canonical, attempt) of the entities whose first surrogate would clash."""
    all_ = parts.select("kind", "canonical").distinct().withColumn("attempt", F.lit(0))
    all_ = stored(all_, "entities")
    given = F.col("kind") != "given"
    later = None
    for _ in range(ROUNDS):
        made = all_.where(given).withColumn(
            "surrogate", _mapped(F.col("kind"), F.col("canonical"), F.col("canonical"), key, F.col("attempt"))
        )
        # Cards that aren't valid numbers are left as they are and clash with nothing.
        made = stored(made.where((F.col("kind") != "card") | (F.col("surrogate") != F.col("canonical"))), "surrogates")
        twice = made.groupBy("kind", "surrogate").agg(F.min("canonical").alias("first"), F.count("*").alias("n"))
        twice = made.join(twice.where("n > 1"), ["kind", "surrogate"]).where("canonical <> first")
        real = made.select("kind", F.col("canonical").alias("surrogate"))
        clash = twice.select("kind", "canonical").union(
            made.join(real, ["kind", "surrogate"], "left_semi").select("kind", "canonical")
        )
        clash = stored(clash.distinct().withColumn("again", F.lit(1)), "clashes")
        if clash.isEmpty():
            return later if later is not None else all_.limit(0)
        again = all_.join(clash, ["kind", "canonical"], "left")
        attempt = F.col("attempt") + F.coalesce("again", F.lit(0))
        all_ = stored(again.select("kind", "canonical", attempt.alias("attempt")), "entities")
        later = stored(all_.where("attempt > 0"), "later")
    raise ValueError("too few distinct surrogates for the entities of some type")


def replace(docs: DataFrame, key: str) -> DataFrame:
    """`docs` with entities in `text` replaced, and n_entities.

    One row per input row with all its columns; a column n_entities is replaced. NULL
    stays NULL and empty stays empty, with no entities; texts without entities are
    unchanged; repeated rows are changed alike; an empty table gives none. Mentions of
    an entity agree in all documents. Names are found as a common given name and a
    surname, and then each part wherever it stands alone in that text.

    Texts are read once for the entities and once for replacing; only entities are
    shuffled, and texts meet the few later attempts by their own lists of entities.
    """
    text = F.col("text").cast("string")
    found = _found(docs.select(text.alias("text")), F.col("text")).select(_q(_ENTITIES).alias("entities"))
    part = F.explode(F.flatten(F.transform("entities", _parts)))
    parts = found.where(F.size("entities") > 0).select(part.alias("part")).select("part.kind", "part.core")
    parts = parts.select("kind", _canonical(F.col("kind"), F.col("core")).alias("canonical"))
    later = _attempts(parts, key)

    # Later attempts, by entity, for the texts that hold such an entity.
    named = _found(docs, text)
    few = later.count()
    if few:
        every = docs.select(text.alias("text")).distinct()
        every = _found(every, F.col("text")).where(F.size(_q(_ENTITIES)) > 0)
        exploded = every.select("text", F.explode(F.flatten(F.transform(_q(_ENTITIES), _parts))).alias("part"))
        exploded = exploded.select("text", "part.kind", _canonical(F.col("part.kind"), F.col("part.core")).alias("canonical"))
        met = exploded.join(later, ["kind", "canonical"]).select(
            F.xxhash64("text").alias("row"), F.concat_ws("|", "kind", "canonical").alias("entity"), "attempt"
        )
        by_text = met.distinct().groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("entity", "attempt"))).alias(_LATER))
        by_text = stored(by_text.withColumnRenamed("row", _LATER + "_row"), "later-by-text")
        named = named.join(by_text, F.xxhash64(text) == _q(_LATER + "_row"), "left").drop(_q(_LATER + "_row"))
    else:
        named = named.withColumn(_LATER, F.lit(None).cast("map<string,int>"))

    given = _literals(_given(key))

    def surrogate(x: Column) -> Column:
        kind, core = x["kind"], x["core"]
        canonical = _canonical(kind, core)
        attempt = F.coalesce(F.element_at(_q(_LATER), F.concat_ws("|", kind, canonical)), F.lit(0))
        new = F.when(kind == "given", F.coalesce(F.element_at(given, core), core)).otherwise(
            _mapped(kind, core, canonical, key, attempt)
        )
        return F.concat(x["before"], new)

    whole = lambda entity: F.array_join(F.transform(_parts(entity), surrogate), "")
    between = F.split(text, _q(_PATTERN), -1)
    new = F.transform(_q(_ENTITIES), whole)
    joined = F.array_join(F.zip_with(between, new, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    changed = F.when(F.size(_q(_ENTITIES)) > 0, joined).otherwise(text)
    return (
        named.withColumn("n_entities", F.coalesce(F.size(_q(_ENTITIES)), F.lit(0)).cast("long"))
        .withColumn("n_entities", F.greatest("n_entities", F.lit(0)))
        .withColumn("text", changed)
        .drop(_PATTERN, _ENTITIES, _LATER)
    )

