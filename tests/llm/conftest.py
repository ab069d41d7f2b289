from __future__ import annotations

import random

import pytest

CLASHES = ["key", "n", "cid", "tag", "g", "own", "rank", "bucket", "epoch", "domain", "rid", "tid", "length", "start", "word", "names", "root", "d2",
           "kept", "held_out", "score", "_c0", "text_old", "amount", "z"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHES)


def make_rows() -> list[tuple]:
    """Documents with every hard case: nulls in each column, empty, blank and long texts, copies, near copies, repeated rows."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    rows: list[tuple] = []
    add = lambda i, t, lang="en", source="src0": rows.append((i, t, lang, source))
    base = [say(rng.randint(30, 90)) + ".\n" + say(40) for _ in range(60)]
    for i, t in enumerate(base):
        add(100 + i, t, rng.choice(["en", "de"]), rng.choice(["src0", "src1", "src2"]))
    for i in range(12):  # exact and near copies, some in another case
        add(300 + i, base[i % 4])
        parts = base[i % 4].split(" ")
        parts[rng.randrange(len(parts))] = "changed"
        add(400 + i, " ".join(parts))
        add(500 + i, base[5].upper() if i % 2 else base[5])
    passage = say(45)
    for i in range(8):
        add(600 + i, say(25) + "\n" + passage + "\n" + say(20))
    add(700, None)
    add(701, "")
    add(702, " \n\t ")
    add(703, "x")
    add(704, "one two three")
    add(705, "one two three")
    add(706, "y" * 30_000)
    add(707, "again and again " * 60)
    add(708, say(4_000))
    add(709, "z9 " * 300)
    add(710, "line one is here\nline one is here\n\nline two\nline one is here " + say(30))
    add(711, base[7], None, None)
    add(712, base[8], "en", None)
    add(713, base[9], None, "src1")
    add(None, base[10])
    add(None, base[10])
    add(None, None, None, None)
    add(714, base[11])
    add(714, base[11])  # a repeated row
    add(715, base[12])
    add(715, base[13])  # a repeated id with another text
    add(716, "Müller ärgert große Öfen " * 3 + say(20) + " — “quoted”   ñandú 😀 😀")
    add(-5, say(50))
    return rows


def frame(spark, rows, parts: int = 4):
    full = [(i, t, lang, source, len(t) if t is not None else None, *["clash"] * len(CLASHES)) for i, t, lang, source in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts) if full else spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def rows() -> list[tuple]:
    return make_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return frame(spark, rows).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, [])
