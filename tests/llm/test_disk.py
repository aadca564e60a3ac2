"""What joins of near copies keep on disk."""

from __future__ import annotations

import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywright.llm import circulant_minhash as minhash
from tallywright.llm import ngram_join
from tallywright.llm.circulant_minhash import circulant_minhash
from tallywright.llm.common import FILE_CLEANUP, written
from tallywright.llm.ngram_join import band_ranges, ngram_jaccard_join, signatures
from tests.llm.test_groups import brute, near_copies


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(at).getName() for at in range(files.size()) if files.apply(at).getName().startswith("shuffle_")}


def test_shuffle_files_go_with_the_table_they_made(spark):
    before, usual = shuffle_files(spark), spark.conf.get(FILE_CLEANUP, None)
    table = written(spark.range(10_000).groupBy((F.col("id") % 100).alias("key")).count(), "counted")
    assert table.count() == 100 and spark.conf.get(FILE_CLEANUP, None) == usual
    counting = shuffle_files(spark)  # the count above has one of its own
    for _ in range(50):
        left = {name for name in counting & shuffle_files(spark) if name not in before and name.endswith(".data")}
        if len({name.split("_")[1] for name in left}) <= 1:
            break
        time.sleep(0.1)
    assert len({name.split("_")[1] for name in left}) <= 1


def test_ranges_of_bands_hold_each_signature_once(monkeypatch):
    monkeypatch.setattr(ngram_join, "PASS_ELEMENTS", 1000)
    rng = np.random.default_rng(2)
    for num, den in ((9, 10), (8, 10), (1, 2)):
        sizes = [1, 2, 3, 10, 11, 12, 90, 100, 110, 300, 301, 2000]
        ranges = band_ranges({n: n for n in sizes}, num, den)
        assert 1 < len(ranges) <= ngram_join.MOST_PASSES
        assert all(last < first for (_, last), (first, _) in zip(ranges, ranges[1:]))
        for n in sizes:
            elements = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            parts = [signatures(elements, num, den, 3, *span) for span in ranges]
            assert Counter(np.concatenate(parts).tolist()) == Counter(signatures(elements, num, den).tolist())
    assert band_ranges({}, 9, 10) == []


@pytest.mark.parametrize(("size", "num", "den", "seed"), [(3, 90, 100, 4), (1, 6, 10, 5)])
def test_links_by_passes_match_brute_force(spark, monkeypatch, size, num, den, seed):
    monkeypatch.setattr(ngram_join, "PASS_ELEMENTS", 500)
    monkeypatch.setattr(minhash, "PASS_PAIRS", 20)
    tables = []
    for module in (ngram_join, minhash):
        monkeypatch.setattr(module, "written", lambda df, name, f=module.written: tables.append(name) or f(df, name))
    rows = [*near_copies(seed), (900, None), (901, ""), (None, "alone here")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    expected = brute(rows, size, num, den)
    got = ngram_jaccard_join(df, size=size, threshold=(num, den)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == expected
    assert tables.count("shared-in-pass") > 1 and tables.count("compared") > 1
    assert Counter(r.component_id for r in got if r.kept and r.n_shingles).most_common(1)[0][1] == 1


def test_comparisons_by_passes_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(minhash, "PASS_PAIRS", 20)
    # nothing is broadcast: joins of large tables
    monkeypatch.setattr(minhash, "BROADCAST_ROWS", 0)
    rows = near_copies(6)
    got = circulant_minhash(spark.createDataFrame(rows, "doc_id long, text string"), size=2, threshold=(9, 10)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, 2, 9, 10)


def test_whole_rows_are_not_shuffled_for_their_answers(spark):
    df = spark.createDataFrame(near_copies(7), "doc_id long, text string")
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # no estimate decides it
    try:
        joined = ngram_jaccard_join(df, carry=("doc_id", "text"))
        assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == df.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
