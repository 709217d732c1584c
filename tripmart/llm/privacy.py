"""Surrogates for personal data and secrets, in DataFrame operations only.

Entities are found by one pattern. Each distinct one gets a replacement of its own type and form, made from a keyed
hash: digits for digits, letters for letters, a card number with a right check digit, a name of the same gender and
script. Replacements are checked against each other and against all real entities, and those that collide are made
anew, so that different entities stay different and one entity is the same in all documents, however it is written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.tables import written

# Titles by the gender they tell, the names of secrets, and syllables of names by script.
MALE = ("Mr", "Herr", "Señor", "Monsieur", "г-н")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Madame", "Mme", "г-жа")
NEUTRAL = ("Dr", "Prof")
SECRETS = r"password|passwd|token|secret|api[_-]?key"
SYLLABLES = {
    "latin": ("ba de fi go lu ma ne ri so ta ve ka la mi no ru", "na la ra sa da ta va ma", "n l r s d t k m"),
    "cyrillic": ("ба де фи го лу ма не ри со та ве ка ла ми но ру", "на ла ра са да та ва ма", "н л р с д т к м"),
    "greek": ("βα δε φι γο λυ μα νε ρι σο τα βε κα λα μι νο ρυ", "να λα ρα σα δα τα βα μα", "ς ν ρ λος νος ρος σιος τος"),
}

_TITLES = "|".join(sorted(MALE + FEMALE + NEUTRAL, key=len, reverse=True))
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
# A domain has 127 labels at most. Unbounded, Java would recurse for each, and run out of stack in a text full of dots.
_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+){0,125}\.[A-Za-z]{2,}"
_SECRET = rf"\b(?i:{SECRETS})\s?[=:]\s?[\"']?[A-Za-z0-9/+_-]{{8,}}"
_CLOUD_KEY = r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])"
_ADDRESS = rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])"
_ACCOUNT = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
_NUMBER = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
_CARD = r"(?<![0-9])(?:[0-9]{4}[ -]){3}[0-9]{4}(?![0-9])|(?<![0-9A-Za-z.])[0-9]{13,19}(?![0-9A-Za-z])"
_PHONE = (
    r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}(?![0-9])"
    r"|(?<![0-9A-Za-z])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}(?![0-9])"
    r"|(?<![0-9.-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![0-9])"
)
_NAME = rf"(?<![\p{{L}}])(?:{_TITLES})\.? \p{{Lu}}\p{{L}}+(?: \p{{Lu}}\p{{L}}+)?"
ENTITY = "|".join((_EMAIL, _SECRET, _CLOUD_KEY, _ADDRESS, _ACCOUNT, _NUMBER, _CARD, _PHONE, _NAME))
#: Every entity has this; most texts don't.
HINT = rf"[0-9@]|(?:AKIA|ASIA)[A-Z0-9]{{16}}|(?:{_TITLES})\.? \p{{Lu}}|(?i:{SECRETS})\s?[=:]"

#: Attempts at a surrogate of its value's form; from then on each is longer by one more character.
IN_FORM = 4


def has_entity(text: Column) -> Column:
    return F.coalesce(text.rlike(HINT) & text.rlike(ENTITY), F.lit(False))


def _kind(entity: Column) -> Column:
    return (
        F.when(entity.rlike(rf"^(?:{_TITLES})\.? "), "name")
        .when(entity.rlike(rf"^(?i:{SECRETS})\s?[=:]"), "secret")
        .when(F.contains(entity, F.lit("@")), "email")
        .when(entity.rlike("^(?:AKIA|ASIA)"), "cloud-key")
        .when(entity.rlike(f"^(?:{_OCTET}\\.){{3}}{_OCTET}$"), "address")
        .when(entity.rlike("^[A-Z]{2}[0-9]{2}"), "account")
        .when(entity.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "number")
        .when(entity.rlike(r"^(?:[0-9]{4}[ -]?){3}[0-9]{1,7}$"), "card")
        .otherwise("phone")
    )


def _script(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _parts(kind: Column, entity: Column) -> Column:
    """What of an entity is replaced: (type, value) pairs, the value in a form that doesn't depend on how it's written."""
    words = F.split(entity, " ")
    title = F.regexp_replace(words[0], r"\.$", "")
    gender = F.when(title.isin(*MALE), "male").when(title.isin(*FEMALE), "female").otherwise("neutral")
    last = F.element_at(words, -1)

    def part(name: Column, value: Column) -> Column:
        return F.struct(name.alias("type"), value.alias("value"))

    given = part(F.concat(F.lit("given-"), gender, F.lit("-"), _script(words[1])), words[1])
    family = part(F.concat(F.lit("family-"), _script(last)), last)
    value = (
        F.when(kind == "email", F.lower(entity))
        .when(kind == "secret", F.regexp_extract(entity, r"([A-Za-z0-9/+_-]{8,})$", 1))
        .when(kind.isin("card", "phone", "number"), F.regexp_replace(entity, "[^0-9]", ""))
        .when(kind == "account", F.regexp_replace(entity, " ", ""))
        .otherwise(entity)
    )
    return F.when(kind == "name", F.when(F.size(words) > 2, F.array(given, family)).otherwise(F.array(family))).otherwise(F.array(part(kind, value)))


def _surrogate(key: str, attempt: int) -> Column:
    """A replacement of ``value`` of ``type``; another for each attempt.

    A form may have fewer values than the corpus has entities of it (five digits), or only the real one (a password of
    dashes). So surrogates grow after some attempts, and there are always more.
    """
    value, kind = F.col("value"), F.col("type")
    seed = F.concat_ws("\x1f", F.lit(key), kind, value, F.lit(str(attempt)))
    stream = F.concat(F.sha2(seed, 256), F.sha2(F.concat(seed, F.lit("\x1f")), 256))
    digits = F.translate(stream, "abcdef", "273849")
    small = F.translate(F.concat(F.sha2(F.reverse(seed), 256), F.sha2(F.concat(F.reverse(seed), F.lit("\x1f")), 256)), "0123456789", "ghkmnprstv")

    def in_form(text: Column, hexadecimal: Column = F.lit(False)) -> Column:
        """Small letters, capitals and digits of ``text`` each by another of their class; the rest as it is."""

        def one(c: Column, i: Column) -> Column:
            at = (i % 128) + 1
            letter = F.when(hexadecimal, F.translate(F.substr(stream, at, F.lit(1)), "0123456789", "abcdefabcd")).otherwise(F.substr(small, at, F.lit(1)))
            return F.when(c.rlike("^[0-9]$"), F.substr(digits, at, F.lit(1))).when(c.rlike("^[a-z]$"), letter).when(c.rlike("^[A-Z]$"), F.upper(letter)).otherwise(c)

        return F.array_join(F.transform(F.split(text, ""), one), "")

    extra = min(max(0, attempt - IN_FORM + 1), 40)
    more_digits, more_letters = (F.substr(x, F.lit(129 - extra), F.lit(extra)) if extra else F.lit("") for x in (digits, small))
    more_hex = F.substr(stream, F.lit(129 - extra), F.lit(extra)) if extra else F.lit("")
    octets = [(F.conv(F.substr(stream, F.lit(2 * k + 1), F.lit(2)), 16, 10).cast("int") % 254 + 1).cast("string") for k in range(4 + extra)]
    length = F.length(value) + extra
    body = F.concat(F.substr(value, F.lit(1), F.lit(1)), F.substr(digits, F.lit(1), length - 2))
    checks = F.filter(F.array(*[F.lit(str(k)) for k in range(10)]), lambda d: F.call_function("luhn_check", F.concat(body, d)))
    country = F.greatest(F.length(value) - 10, F.lit(0))
    # a short number may begin with any digit, as few others are free
    phone = F.when(length < 10, F.substr(digits, F.lit(1), length)).otherwise(
        F.concat(F.substr(value, F.lit(1), country), F.lit("2"), F.substr(digits, F.lit(1), length - country - 1))
    )

    def name(script: str, ending: str) -> Column:
        begin, female, male = (F.array(*[F.lit(x) for x in group.split()]) for group in SYLLABLES[script])
        # more syllables for each attempt, so that there is always another name
        nibbles = [F.conv(F.substr(stream, F.lit(k + 1), F.lit(1)), 16, 10).cast("int") for k in range(4 + attempt % 40)]
        parts = [F.element_at(begin, n + 1) for n in nibbles[:-1]]
        last = {"female": female, "male": male, "neutral": begin}[ending]
        return F.initcap(F.concat(*parts, F.element_at(last, nibbles[-1] % F.size(last) + 1)))

    out = (
        F.when(kind == "email", F.concat(in_form(F.substring_index(value, "@", 1)), more_letters, F.lit("@"), in_form(F.substring_index(F.substring_index(value, "@", -1), ".", 1)), F.lit(".example")))
        .when(kind == "address", F.concat_ws(".", *octets))
        .when(kind == "card", F.concat(body, F.element_at(checks, 1)))
        .when(kind == "phone", phone)
        .when(kind == "cloud-key", F.concat(F.substr(value, F.lit(1), F.lit(4)), in_form(F.substr(value, F.lit(5))), F.upper(more_letters)))
        .when(kind == "account", F.concat(F.substr(value, F.lit(1), F.lit(2)), in_form(F.substr(value, F.lit(3))), more_digits))
        .when(kind == "secret", F.concat(in_form(value, value.rlike("^[0-9a-f]+$")), more_hex))
    )
    for script in SYLLABLES:
        out = out.when(kind == f"family-{script}", name(script, "neutral"))
        for gender in ("male", "female", "neutral"):
            out = out.when(kind == f"given-{gender}-{script}", name(script, gender))
    return out.otherwise(F.concat(in_form(value), more_digits))


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """Replacements of distinct entities (type, value): type, value, surrogate. Different values of a type have
    different surrogates, none of them a real value of the type. ``entities`` is a written table.

    The few that find no free value of their form get a longer one.
    """
    real = entities.select(F.col("type").alias("real_type"), F.col("value").alias("real_value"))
    left, done, attempt = entities, None, 0
    while True:
        made = left.withColumn("surrogate", _surrogate(key, attempt))
        best = made.groupBy(F.col("type").alias("its_type"), F.col("surrogate").alias("its_surrogate")).agg(F.min("value").alias("owner"))
        checked = made.join(best, (F.col("type") == F.col("its_type")) & (F.col("surrogate") == F.col("its_surrogate")))
        checked = checked.join(real, (F.col("type") == F.col("real_type")) & (F.col("surrogate") == F.col("real_value")), "left")
        fine = (F.col("owner") == F.col("value")) & F.col("real_value").isNull()
        if done is not None:
            taken = done.select(F.col("type").alias("taken_type"), F.col("surrogate").alias("taken"))
            checked = checked.join(taken, (F.col("type") == F.col("taken_type")) & (F.col("surrogate") == F.col("taken")), "left")
            fine = fine & F.col("taken").isNull()
        checked = written(checked.select("type", "value", "surrogate", fine.alias("fine")))
        good = checked.filter("fine").select("type", "value", "surrogate")
        done = good if done is None else done.unionByName(good)
        left, attempt = checked.filter("NOT fine").select("type", "value"), attempt + 1
        if left.isEmpty():
            return done


def occurrences(df: DataFrame) -> DataFrame:
    """Entities in the texts of ``df`` (doc_id, text): doc_id, text_hash, place (from 0), entity, kind, part, type, value."""
    found = df.filter(has_entity(F.col("text"))).select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.regexp_extract_all("text", F.lit(ENTITY), F.lit(0)))
    )
    found = found.select("doc_id", "text_hash", F.col("pos").alias("place"), F.col("col").alias("entity"), _kind(F.col("col")).alias("kind"))
    found = found.select("*", F.posexplode(_parts(F.col("kind"), F.col("entity"))))
    return found.select("doc_id", "text_hash", "place", "entity", "kind", F.col("pos").alias("part"), F.col("col.type").alias("type"), F.col("col.value").alias("value"))


def _rendered(kind: Column, entity: Column, parts: Column) -> Column:
    """An entity written with the surrogates of its parts."""
    first = parts[0]
    gaps = F.split(entity, "[0-9]", -1)
    # a surrogate may have more digits than the entity
    digits = F.split(first, "")
    filled = F.array_join(F.zip_with(gaps, digits, lambda gap, digit: F.concat(F.coalesce(gap, F.lit("")), F.coalesce(digit, F.lit("")))), "")
    return (
        F.when(kind.isin("card", "phone", "number"), filled)
        .when(kind == "secret", F.concat(F.regexp_extract(entity, r"^(.*?)[A-Za-z0-9/+_-]{8,}$", 1), first))
        .when(kind == "name", F.concat(F.substring_index(entity, " ", 1), F.lit(" "), F.array_join(parts, " ")))
        .otherwise(first)
    )


def replace(df: DataFrame, key: str) -> DataFrame:
    """The rows of ``df``, all columns, with surrogates in ``text``, and after them n_entities and entity_kinds.

    Rows are told apart by doc_id and text; equal rows get equal results, each its own row, and a null doc_id is an id
    like others. A null text stays null and has no entities. If there is a column n_chars, it follows the new text.
    Texts without entities don't move; the others are joined to their replacements. The new columns are named by the
    caller's choice in ``replaced_rows``; here they must not be there already.
    """
    return replaced_rows(df, key).select("whole.*", "n_entities", "entity_kinds")


def replaced_rows(df: DataFrame, key: str) -> DataFrame:
    """``whole`` (a struct of the row with its new text), n_entities and entity_kinds (sorted, by commas)."""
    found = written(occurrences(df.select("doc_id", "text")))
    chosen = surrogates(written(found.select("type", "value").distinct()), key)
    chosen = chosen.select(F.col("type").alias("its_type"), F.col("value").alias("its_value"), "surrogate")
    joined = found.join(chosen, (F.col("type") == F.col("its_type")) & (F.col("value") == F.col("its_value")))
    # the parts of an entity meet first, one or two of them; equal rows give the same ones
    entities = joined.groupBy(F.col("doc_id").alias("id"), F.col("text_hash").alias("its_hash"), "place").agg(
        F.first("kind").alias("kind"), F.first("entity").alias("entity"), F.sort_array(F.collect_set(F.struct("part", "surrogate"))).alias("parts")
    )
    renewed = _rendered(F.col("kind"), F.col("entity"), F.transform("parts", lambda x: x["surrogate"]))
    texts = entities.groupBy("id", "its_hash").agg(
        F.sort_array(F.collect_list(F.struct("place", renewed.alias("renewed")))).alias("found"),
        F.count("*").alias("n_entities"),
        F.array_join(F.sort_array(F.collect_set("kind")), ",").alias("entity_kinds"),
    )
    texts = texts.select("id", "its_hash", F.transform("found", lambda x: x["renewed"]).alias("renewed"), "n_entities", "entity_kinds")
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    clean = df.filter(~has_entity(F.col("text"))).select(whole.alias("whole"), F.lit(0).cast("long").alias("n_entities"), F.lit("").alias("entity_kinds"))
    private = df.filter(has_entity(F.col("text"))).select(
        whole.alias("whole"), F.col("doc_id").alias("own_id"), F.xxhash64("text").alias("own_hash"), F.split("text", ENTITY, -1).alias("between")
    )
    private = private.join(texts, F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_hash") == F.col("its_hash")))
    text = F.array_join(F.zip_with("between", "renewed", lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    changed = F.col("whole").withField("text", text)
    if "n_chars" in df.columns:
        changed = changed.withField("n_chars", F.length(text).cast(df.schema["n_chars"].dataType))
    return clean.unionByName(private.select(changed.alias("whole"), "n_entities", "entity_kinds"))
