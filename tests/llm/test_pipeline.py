import importlib

import numpy as np
import pytest

from pathcredit.llm import decontamination, minhash, quality
from tests.llm import brute
from tests.llm.conftest import tricky_rows
from tests.llm.test_operators import check_packed


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """A small folder of tables: tricky rows, labelled junk, leaks and variants."""
    folder = tmp_path_factory.mktemp("corpus")
    item = " ".join(f"question{k}" for k in range(30))
    rows = [r for r in tricky_rows() if r[0] is not None and r[0] != 63]
    rows += [(200 + i, " ".join(f"junk{i}x{k} |" for k in range(60))) for i in range(30)]
    rows += [(300 + i, " ".join(f"fine{i}y{k}" for k in range(60))) for i in range(60)]
    rows += [(400, "see " + item + " yes"), (401, " ".join(f"fine1y{k}" for k in range(58)) + " new end")]
    labels = [(200 + i, 0, 0) for i in range(30)] + [(300 + i, 1, 0) for i in range(60)]
    frames = {"documents": (rows, "doc_id long, text string"), "benchmark": ([(1, item)], "item_id long, text string"), "labels": (labels, "doc_id long, quality int, toxic int")}
    for name, (data, ddl) in frames.items():
        spark.createDataFrame(data, ddl).write.parquet(f"{folder}/{name}.parquet")
    return str(folder), rows, labels, [(1, item)]


def test_pipeline_matches_brute_force(spark, corpus):
    import corpus_pipeline

    folder, rows, labels, items = corpus
    got = corpus_pipeline.run(spark, folder).collect()

    stats = {r["doc_id"]: r for r in quality.statistics(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    value = lambda i, a, b: float(stats[i][a]) / (max(1, stats[i][b]) if b else 1)
    x = {i: np.array([value(i, a, b) for a, b in quality._ratios().values()]) for i in stats}
    failed = {i: (c := brute.counts(t))[0] < 20 or 100 * c[4] > 30 * c[0] for i, t in rows}
    rules = quality.learned(quality.statistics(spark.createDataFrame(rows, "doc_id long, text string")), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert rules
    rows = [(i, t) for i, t in rows if not failed[i] and not any(quality.covers(r, x[i][None])[0] for r in rules)]
    assert not any(200 <= i < 300 for i, _ in rows) and sum(300 <= i < 400 for i, _ in rows) == 60
    rows = brute.line_dedup(rows)
    near = brute.near_duplicates(rows, minhash.CORPUS.percent)
    rows = [(i, t) for i, t in rows if near[i][2]]
    leaks = {r[0] for r in brute.overlaps(rows, items, decontamination.MASKS)}
    assert leaks == {400}
    check_packed(got, [(i, t) for i, t in rows if i not in leaks])


def test_stages_keep_the_columns(spark, docs, corpus):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "decontaminate", "pack"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, corpus[0])
        assert out.columns == docs.columns
        assert out.filter("doc_id is null").count() == 1


def test_queries_are_registered():
    entry = importlib.import_module("__spark_entry__")
    names = [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    assert len(names) == 14
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["op1_minhash", "op3_decontamination", "op4_substrings", "op11_jaccard", "op13_codes"])
def test_query_matches_oracle(spark, name):
    from tests.conftest import SF001
    from tools.compare import compare, duck

    entry = importlib.import_module("__spark_entry__")
    result = compare(spark, duck(SF001), name, entry.queries()[name], entry.oracle_sql()[name], SF001)
    assert result["rows"] == result["oracle_rows"] and result["cols"] and result["exact"], result
