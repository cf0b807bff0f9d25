import random

import pytest

#: Names that the operators use for columns of their own.
CLASHING = ("n", "rep", "key", "seed", "bundle", "component", "group", "places", "start", "length", "of_doc", "gone_doc", "hit_doc", "numbers", "row", "held_out")


@pytest.fixture(autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def _prose(rng, n):
    parts = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "en", "ing", "é", "ß"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n)]


def _text(rng, w):
    out = []
    while w:
        n = rng.randint(5, 30)
        out.append(" ".join(w[:n]).capitalize() + ".")
        w = w[n:]
    return "\n".join(out)


def tricky_rows():
    """(doc_id, text): copies, near copies, shared passages and lines, nulls, empty,
    blank and very long texts, repeated rows, odd white space."""
    rng = random.Random(5)
    passage = " ".join(_prose(rng, 70))
    base = _prose(rng, 120)
    rows = [(i, _text(rng, _prose(rng, rng.randint(1, 160)))) for i in range(30)]
    rows += [(30 + i, " ".join(base[:i] + ["x" + str(i)] + base[i + 1 :])) for i in range(12)]  # near copies
    rows += [(42 + i, " ".join(_prose(rng, 30)) + " " + passage + " " + " ".join(_prose(rng, 30))) for i in range(6)]
    rows += [(48, " ".join(base)), (49, " ".join(base)), (50, " ".join(base).upper()), (51, passage + " " + passage)]
    rows += [(52, None), (53, ""), (54, " \n\t \n"), (55, "one"), (56, "One"), (57, "a  b   c\n \n  d\t\te   f g")]
    rows += [(58, "".join(_prose(rng, 6000))), (59, " ".join(_prose(rng, 9000))), (60, "ab " * 4000), (61, "\n".join(["same line of words here"] * 40))]
    rows += [(62, "mail a.b+c@ex-ample.co.uk, 10.0.255.1 and 300.1.1.1; 4539 1488 0343 6467 +1 (202) 555-0143 x@y 1.2.3.4.5")]
    rows += [(None, "no id at all"), (63, "twice the same row " * 15), (63, "twice the same row " * 15)]
    return rows


@pytest.fixture(scope="session")
def rows():
    return tricky_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The tricky rows with further columns of clashing names, some null."""
    names = ["doc_id", "text", "lang", *CLASHING]
    kinds = ", ".join(f"{c} {'long' if c == 'doc_id' else 'string'}" for c in names)
    return spark.createDataFrame([(i, t, None if i and i % 3 else "en", *[None if k % 2 else "z" for k in range(len(CLASHING))]) for i, t in rows], kinds)


@pytest.fixture(scope="session")
def empty(spark, docs):
    return spark.createDataFrame([], docs.schema)
