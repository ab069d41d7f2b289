"""PII surrogates: detected entities get keyed replacements of the same type and format, distinct and coreferent.

DataFrame and SQL functions only. One pattern finds the entities of a text; every distinct entity gets a canonical form
(case and separators aside), and one surrogate per canonical form: keyed digests of it, character for
character (digits stay digits, letters letters of the same case, hexadecimal stays hexadecimal, card numbers that pass the Luhn test
still pass it, account numbers with right check digits get right ones, addresses stay addresses, names follow the gender of the title and the script).
Names, of any number of words, are found by their titles and
drawn word for word, so a person's last name alone agrees with the full name; in a text that has the titled name, its untitled full and last
names are replaced too (first names alone, inflected forms and names that have no title anywhere in the text are not found). A last name that is also a common
word (COMMON) is left where it begins a sentence untitled. Surrogates of
one kind that meet, or that are some entity of the corpus, are drawn again with the next attempt number
until none is left, so distinct entities stay distinct; equal ones agree over the whole corpus. What still meets after
PLAIN_ATTEMPTS, because the short forms of a kind run out, gets a digit (a name a syllable) more with every further attempt, before the kept tail; an
address's numbers then go up to 999.
"""
from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.shared import columns, workdir, written

KEY = "sluice-pii-1"
#: Attempts at the entity's own length; later ones are longer, so there is always room.
PLAIN_ATTEMPTS = 16

# What the entities look like, and the titles that mark names.
EMAIL = r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@(?:[A-Za-z0-9\-]++\.)+[0-9\-]*+[A-Za-z][A-Za-z0-9\-]*+"
SECRET = r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+|(?:sk|pk|ghp|gho|xoxb)[_\-][0-9A-Za-z_\-]{16,}+|AKIA[0-9A-Z]{16})(?![0-9A-Za-z])"
IBAN = r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])"
PHONE = (r"(?:\+[0-9]{1,3}(?:[ .\-|!#$%&*]{0,5}\(?[0-9]{2,4}\)?){2,4}|\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}|"
         r"(?<![0-9A-Za-z]|[0-9][ ./\-])(?:[2-9][0-9]{2}(?:-[0-9]{3}-|\.[0-9]{3}\.| [0-9]{3} )[0-9]{4}|"
         r"0[0-9]{2,4}(?:[ /\-][0-9]{5,8}|[ \-][0-9]{3,4}[ \-][0-9]{3,4}))(?![A-Za-z]|[ ./\-]?[0-9]))(?![0-9])")
SSN = r"(?<![0-9A-Za-z\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z\-])"
IP = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
IP6 = (r"(?<![0-9A-Za-z:.])(?=[0-9A-Fa-f:]*[0-9])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|"
       r"(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6}|(?:[0-9A-Fa-f]{1,4}:){1,7}:)(?![0-9A-Za-z:])")
CARD = (r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}(?:-[0-9]{4}){2}-[0-9]{1,7}|[0-9]{4}(?: [0-9]{4}){2} [0-9]{1,7})"
        r"(?![0-9A-Za-z])")
MALE = "Mr|Mister|Sir|Herr|Monsieur|Señor|Sr|Don|Dott|г-н|господин|Κύριος|κ"
FEMALE = "Mrs|Ms|Miss|Madam|Frau|Madame|Mme|Mlle|Señora|Sra|Doña|Dra|Dottoressa|г-жа|госпожа|Κυρία|κα"
WORD = r"\p{Lu}(?:['\-]?(?!(?<=')s(?!\p{L}))\p{L})+"
EITHER = "Dr|Doctor|Prof|Professor|Rev|Hon|д-р|проф|Δρ"
#: Words that sentences begin with, and that are also last names.
COMMON = ("Will", "May", "Long", "Young", "Rich", "Mark", "Bill", "Rose", "Hope", "Grace", "Day", "Price", "Small", "Little", "Sharp", "Best", "Early", "Love",
          "King", "Cook", "Brown", "Black", "White", "Green", "Gray", "Stone", "Field", "Hill", "Wood", "Brook", "Spring", "Winter", "Summer", "Frank", "Grant")
TITLE = rf"(?:(?:{FEMALE}|{MALE}|{EITHER})\.? )+"
NAME = rf"(?<![\p{{L}}\p{{N}}]){TITLE}{WORD}(?: {WORD})*+"
KINDS = {"email": EMAIL, "ip6": IP6, "secret": SECRET, "iban": IBAN, "phone": PHONE, "ssn": SSN, "ip": IP, "card": CARD, "name": NAME}
PATTERN = "|".join(f"(?:{p})" for p in KINDS.values())
#: No entity without one of these: a cheap test before the pattern.
LIKELY = rf"[0-9@]|(?:{FEMALE}|{MALE}|{EITHER})\.? \p{{Lu}}|(?:sk|pk|ghp|gho|xoxb)[_\-]|AKIA|[a-fA-F]{{32}}"
SYLLABLES = ("ba", "be", "bi", "da", "de", "do", "fa", "fe", "ga", "ka", "ki", "la", "le", "li", "lo", "ma", "me", "mi", "mo", "na",
             "ne", "ni", "no", "pa", "pe", "ra", "re", "ri", "ro", "sa", "se", "si", "ta", "te", "ti", "va", "vi", "za", "ze", "zo")
LATIN = "abdefgiklmnoprstvz"
CYRILLIC = "абдефгиклмнопрствз"
GREEK = "αβδεφγικλμνοπρστθζ"


def _kind(entity: Column) -> Column:
    """The first kind whose pattern finds the entity from its start to its end."""
    out = None
    for kind, pattern in KINDS.items():
        is_kind = entity.rlike(f"^(?:{pattern})$")
        out = F.when(is_kind, kind) if out is None else out.when(is_kind, kind)
    return out.otherwise("card")


def _entities(found: DataFrame) -> DataFrame:
    """``(entity, kind, canon, head, tail, at)``: head and tail are the letters and digits kept at either end; a name has a row for each word."""
    e = found.withColumn("kind", _kind(F.col("entity")))
    plain = F.lower(F.regexp_replace("entity", r"[^\p{L}\p{N}]", ""))
    name = F.regexp_extract("entity", rf"^{TITLE}(.*)$", 1)
    canon = (F.when(F.col("kind") == "ip6", F.expr(_IP6_GROUPS)).when(F.col("kind") == "ip", F.regexp_replace("entity", r"(^|\.)0+(?=[0-9])", "$1"))
             .when(F.col("kind") == "name", F.lower(name)).otherwise(plain))
    title = F.regexp_extract("entity", rf"^({TITLE})", 1)
    gender = F.when(title.rlike(rf"(?:^| )(?:{FEMALE})\.? "), "f").when(title.rlike(rf"(?:^| )(?:{MALE})\.? "), "m").otherwise("e")
    script = F.when(name.rlike(r"^\p{IsCyrillic}"), "cyrillic").when(name.rlike(r"^\p{IsGreek}"), "greek").otherwise("latin")
    hexa = F.col("canon").rlike("^[0-9a-f]{32,}$")
    return (e.withColumn("canon", canon)
            .withColumn("kind", F.when(F.col("kind") == "name", F.concat_ws("_", F.lit("name"), gender, script))
                        .when((F.col("kind") == "secret") & hexa, "hex").otherwise(F.col("kind")))
            .select("entity", "kind", F.posexplode(F.when(F.col("kind").startswith("name"), F.split("canon", " ")).otherwise(F.array("canon"))).alias("at", "canon"))
            .withColumn("head", F.expr("CASE kind WHEN 'phone' THEN 1 WHEN 'card' THEN 1 WHEN 'iban' THEN 2 WHEN 'secret' THEN 2 ELSE 0 END"))
            .withColumn("tail", F.when(F.col("kind") == "email", F.length(F.regexp_extract("entity", r"\.([A-Za-z0-9\-]+)$", 1))).otherwise(0)))


#: SQL: an IPv6 address with all its eight groups, without leading zeros.
_IP6_GROUPS = (r"array_join(transform(split(CASE WHEN entity LIKE '%::%' THEN concat(trim(BOTH ':' FROM concat(substring_index(entity, '::', 1), "
               r"repeat(':0', 8 - size(filter(split(entity, ':'), g -> g <> ''))), ':', substr(entity, instr(entity, '::') + 2)))) ELSE entity END, ':'), "
               r"g -> regexp_replace(lower(g), '^0+(?=.)', '')), ':')")


def _mod97(number: str) -> str:
    """SQL: the remainder by 97 of a string of digits and small letters, a letter being its two digits from 10 on."""
    return (f"aggregate(split({number}, ''), 0, (s, c) -> CASE WHEN c = '' THEN s WHEN c RLIKE '[a-z]' THEN (s * 100 + ascii(c) - 87) % 97 "
            f"ELSE (s * 10 + CAST(c AS INT)) % 97 END)")


def _luhn(digits: str) -> str:
    """SQL: the Luhn sum of a string of digits whose last one is not doubled."""
    return (f"aggregate(transform(split(reverse({digits}), ''), (c, i) -> CASE WHEN c = '' THEN 0 WHEN i % 2 = 0 THEN CAST(c AS INT) "
            f"ELSE CAST(c AS INT) * 2 - CASE WHEN CAST(c AS INT) > 4 THEN 9 ELSE 0 END END), 0, (s, x) -> s + x)")


def _drawn(entities: DataFrame, key: str) -> DataFrame:
    """Adds ``sur``: the surrogate of each canonical form at its ``attempt``, and ``extra``: by how much it is longer."""
    longer = "concat(substr(canon, 1, length(canon) - tail), repeat('0', extra), right(canon, tail))"
    byte = "CAST(conv(substr(d, 1 + 2 * (i % 64), 2), 16, 10) AS INT)"
    chars = (f"array_join(transform(split({longer}, ''), (c, i) -> CASE WHEN i < head OR i >= length(canon) + extra - tail THEN c "
             f"WHEN c RLIKE '[0-9]' THEN CAST({byte} % 10 AS STRING) "
             f"WHEN kind = 'hex' THEN substr('abcdef', 1 + {byte} % 6, 1) "
             f"WHEN c = '' THEN c ELSE substr('abcdefghijklmnopqrstuvwxyz', 1 + {byte} % 26, 1) END), '')")
    ip = "concat_ws('.', transform(sequence(0, 3), i -> CAST(1 + CAST(conv(substr(d, 1 + 4 * i, 4), 16, 10) AS INT) % IF(extra > 0, 999, 254) AS STRING)))"
    syllables = "array(" + ", ".join(f"'{s}'" for s in SYLLABLES) + ")"
    stem = (f"array_join(transform(sequence(0, 2 + least(attempt, 4) + least(extra, 20)), i -> element_at({syllables}, "
            f"1 + CAST(conv(substr(d, 1 + 4 * i, 4), 16, 10) AS INT) % {len(SYLLABLES)})), '')")
    ip6 = "concat_ws(':', transform(sequence(0, 7), i -> substr(d, 1 + 4 * i, 4)))"
    ending = "CASE WHEN kind LIKE 'name_f%' THEN 'na' WHEN kind LIKE 'name_m%' THEN 'no' ELSE 'ne' END"
    out = (entities.withColumn("extra", F.greatest(F.col("attempt") - PLAIN_ATTEMPTS, F.lit(0))).withColumn("d", F.sha2(F.concat_ws("|", F.lit(key), "kind", "canon", F.col("attempt").cast("string")), 512))
           .withColumn("sur", F.expr(f"CASE WHEN kind = 'ip' THEN {ip} WHEN kind = 'ip6' THEN {ip6} WHEN kind LIKE 'name%' THEN concat({stem}, {ending}) ELSE {chars} END")))
    rest = "concat(substr(sur, 5), substr(sur, 1, 2), '00')"
    check = "CAST((10 - " + _luhn("concat(substr(sur, 1, length(sur) - 1), '0')") + " % 10) % 10 AS STRING)"
    return out.withColumn("sur", F.expr(
        f"CASE WHEN kind = 'card' AND {_luhn('canon')} % 10 = 0 THEN concat(substr(sur, 1, length(sur) - 1), {check}) "
        f"WHEN kind = 'iban' AND {_mod97('concat(substr(canon, 5), substr(canon, 1, 4))')} = 1 "
        f"THEN concat(substr(sur, 1, 2), lpad(CAST(98 - {_mod97(rest)} AS STRING), 2, '0'), substr(sur, 5)) "
        f"WHEN kind LIKE 'name%cyrillic' THEN translate(sur, '{LATIN}', '{CYRILLIC}') "
        f"WHEN kind LIKE 'name%greek' THEN translate(sur, '{LATIN}', '{GREEK}') ELSE sur END")).drop("d")


def _distinct_surrogates(entities: DataFrame, key: str, base: str) -> DataFrame:
    """One ``sur`` per (kind, canon), no two the same within a kind and none an entity of that kind."""
    forms = written(entities.select("kind", "canon", "head", "tail").groupBy("kind", "canon").agg(F.max("head").alias("head"), F.max("tail").alias("tail"))
                    .withColumn("attempt", F.lit(0)), base, "forms")
    real = forms.select("kind", F.col("canon").alias("sur"), F.lit(True).alias("taken"))
    drawn = written(_drawn(forms, key), base, "drawn-0")
    for attempt in count(1):
        keeper = drawn.groupBy("kind", "sur").agg(F.min(F.struct("attempt", "canon")).alias("keeper"), F.count(F.lit(1)).alias("n"))
        marks = keeper.join(real, ["kind", "sur"], "left").filter((F.col("n") > 1) | F.col("taken"))
        clash = (drawn.join(marks, ["kind", "sur"])
                 .filter(F.col("taken") | (F.col("keeper.canon") != F.col("canon"))).select("kind", "canon", F.lit(True).alias("again")))
        clash = written(clash, base, f"clash-{attempt}")
        if not clash.limit(1).count():
            return drawn.select("kind", "canon", "sur", "tail", "extra")
        both = drawn.join(clash, ["kind", "canon"], "left")
        redrawn = _drawn(both.filter("again").select("kind", "canon", "head", "tail", F.lit(attempt).alias("attempt")), key)
        drawn = written(both.filter("again IS NULL").select(*drawn.columns).unionByName(redrawn.select(*drawn.columns)), base, f"drawn-{attempt}")


def _joined(words: DataFrame) -> DataFrame:
    """One row per entity from its words' surrogates: ``last`` is that of the last word of a name."""
    names = words.filter("kind LIKE 'name%'").groupBy("entity", "kind").agg(F.sort_array(F.collect_list(F.struct("at", "sur"))).alias("all"))
    names = names.select("entity", "kind", F.array_join(F.col("all.sur"), " ").alias("sur"), F.element_at("all.sur", -1).alias("last"),
                         F.lit(0).alias("tail"), F.lit(0).alias("extra"))
    return words.filter("kind NOT LIKE 'name%'").select("entity", "kind", "sur", F.lit(None).cast("string").alias("last"), "tail", "extra").unionByName(names)


def _entries() -> Column:
    """What a text with the entity has replaced: the entity itself and, for a name, its untitled full and last name."""
    name = F.regexp_extract("entity", rf"^{TITLE}(.*)$", 1)
    entry = lambda e, s, mention: F.struct(e.alias("entity"), s.alias("surrogate"), F.lit(mention).alias("mention"))
    own = entry(F.col("entity"), _laid_out(), False)
    return F.when(F.col("last").isNull(), F.array(own)).otherwise(F.array(
        own, entry(name, F.initcap("sur"), True), entry(F.substring_index(name, " ", -1), F.initcap("last"), True)))


def _laid_out() -> Column:
    """The surrogate in the entity's own format: separators, case, title and kept ends as they were."""
    at = r"length(regexp_replace(substr(entity, 1, i + 1), '[^\\p{L}\\p{N}]', ''))"
    own = f"{at} + IF({at} > length(sur) - extra - tail, extra, 0)"
    more = f"IF({at} = length(sur) - extra - tail, substr(sur, {at} + 1, extra), '')"
    cased = f"concat(CASE WHEN c <> lower(c) THEN upper(substr(sur, {own}, 1)) ELSE substr(sur, {own}, 1) END, {more})"
    title = "regexp_extract(entity, '^(" + TITLE.replace("\\", "\\\\") + ")', 1)"
    return F.expr(
        f"CASE WHEN kind IN ('ip', 'ip6') THEN sur WHEN kind LIKE 'name%' THEN concat({title}, initcap(sur)) "
        rf"ELSE array_join(transform(split(entity, ''), (c, i) -> CASE WHEN c RLIKE '[\\p{{L}}\\p{{N}}]' THEN {cased} ELSE c END), '') END")


def surrogate_pii(docs: DataFrame, key: str = KEY, text_col: str = "text", count_col: str | None = "n_entities") -> DataFrame:
    """``docs`` with every entity in its text column replaced, and ``count_col`` (replaced occurrences; None: not wanted) as the last column.

    A column of that name in ``docs`` gives way to it.

    All other columns and all rows stay as they are, whatever they hold; null texts stay null, empty ones empty, both with
    0 entities. Equal texts get equal results, and so do equal entities of one kind wherever they occur.
    """
    base = workdir(docs.sparkSession, "pii")
    # A text's map is found by its hash; texts whose hashes meet share one map, which then just holds both texts' entities.
    mine = {c: f"_{i}" for i, c in enumerate(docs.columns)}
    rows = docs.select(*[F.col(f"`{c}`").alias(a) for c, a in mine.items()], F.col(f"`{text_col}`").alias("text"))
    likely = F.col("text").rlike(LIKELY)
    held = rows.filter(likely)
    found = held.select(F.xxhash64("text").alias("rid"), F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)))).alias("entity"))
    found = written(found.distinct(), base, "found")
    entities = written(_entities(found.select("entity").distinct()), base, "entities")
    named = entities.drop("tail").join(_distinct_surrogates(entities, key, base), ["kind", "canon"])
    named = _joined(named).select("entity", _entries().alias("entries"))
    named = written(named, base, "named")
    # Persons of one last name in a text: its bare mentions get the first of their surrogates.
    maps = found.join(named, "entity").groupBy("rid").agg(F.sort_array(F.flatten(F.collect_list("entries"))).alias("all"))
    maps = maps.select("rid", F.filter("all", lambda e, i: (i == 0) | (e["entity"] != F.col("all")[F.greatest(i - 1, F.lit(0))]["entity"])).alias("all"))
    begins = F.lit(r"(?<!(?:^|[.!?:\n]\s{0,2}))")
    mentions = F.array_join(F.transform(F.reverse(F.filter("all", lambda e: e["mention"])["entity"]),
                                        lambda e: F.when(e.isin(*COMMON), F.concat(begins, e)).otherwise(e)), "|")
    maps = maps.select("rid", F.map_from_entries(F.transform("all", lambda e: F.struct(e["entity"], e["surrogate"]))).alias("names"),
                       F.when(mentions != "", F.concat(F.lit(PATTERN + r"|(?<![\p{L}\p{N}])(?:"), mentions, F.lit(r")(?![\p{L}\p{N}])")))
                       .otherwise(F.lit(PATTERN)).alias("pattern"))
    joined = held.withColumn("rid", F.xxhash64("text")).join(maps, "rid", "left")
    ents = F.regexp_extract_all("text", F.col("pattern"), F.lit(0))
    pieces = F.zip_with(F.split("text", F.col("pattern"), -1), F.col("ents"), lambda p, e: F.concat(p, F.coalesce(F.col("names")[e], e, F.lit(""))))
    joined = (joined.withColumn("ents", F.when(F.col("names").isNotNull(), ents))
              .withColumn("new_text", F.when(F.col("names").isNotNull(), F.array_join(pieces, "")).otherwise(F.col("text")))
              .withColumn("n_entities", F.coalesce(F.array_size("ents"), F.lit(0)).cast("long")))
    others = rows.filter(~F.coalesce(likely, F.lit(False))).select("*", F.col("text").alias("new_text"), F.lit(0).cast("long").alias("n_entities"))
    both = joined.select(*others.columns).unionByName(others)
    return both.select(*[(F.col("new_text") if c == text_col else F.col(a)).alias(c) for c, a in mine.items() if c != count_col],
                       *[F.col("n_entities").alias(c) for c in [count_col] if c])
