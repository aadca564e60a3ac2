"""Circulant MinHash groups, fill-in-the-middle and periodic runs."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from tallywright.llm import circulant_minhash as minhash
from tallywright.llm.circulant_minhash import circulant_minhash
from tallywright.llm.fill_in_middle import fill_in_middle, restored
from tallywright.llm.ngram_join import ngram_jaccard_join
from tallywright.llm.periodic_runs import Grammar, collapsed_lot, periodic_runs
from tallywright.llm.queries import with_repeats
from tests.llm.test_groups import brute, near_copies

FOLDER = "/root/testdata/sf0.001"
ODD = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "a b c " * 400), (6, "Größe ñ 北京 é 🙂  x y <S"),
    (7, "same line\nsame line\nother"), (7, "same line\nsame line\nother"), (None, "no id here at all"),
    (None, None), (9, "w " * 30_000), (10, "holds <M> itself"), (11, "x\r\ny\x00z "), (12, "a < P > b <<S>"),
]


def odd(spark, rows=ODD):
    """Rows with extra columns whose names clash with results and working columns."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.selectExpr(
        "*", "1 AS n", "'f' AS form", "2 AS runs", "3 AS _row", "4 AS component_id", "'t' AS _text", "5 AS kept",
        "6 AS _words", "7 AS _bands", "8 AS output", "9 AS n_words",
    )


CLASHING = ("n", "form", "runs", "_row", "component_id", "_text", "kept", "_words", "_bands", "output", "n_words", "text")


def documents():
    return duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall()


# circulant MinHash


@pytest.mark.parametrize(("size", "num", "den", "seed"), [(5, 85, 100, 1), (2, 90, 100, 3)])
def test_groups_match_brute_force(spark, size, num, den, seed):
    rows = near_copies(seed) + [(1000 + i, t) for i, t in ODD if i is not None and i != 9]
    rows += [(3, rows[3][1]), (None, rows[3][1]), (None, "alone here"), (507, "long " * 5000), (508, "Long " * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = circulant_minhash(df, size=size, threshold=(num, den)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, size, num, den)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_groups_of_odd_rows_and_clashing_names(spark):
    got = circulant_minhash(odd(spark), carry=CLASHING)
    assert got.columns == [*CLASHING, "doc_id", "n_shingles", "_component_id", "_kept"]
    rows = got.collect()
    assert {(r.n, r.form, r._row, r.component_id, r._text, r.kept) for r in rows} == {(1, "f", 3, 4, "t", 5)}
    assert Counter((r.doc_id, r.text) for r in rows) == Counter(ODD)
    assert Counter((r.doc_id, r.n_shingles, r._component_id) for r in rows) == brute(ODD, 5, 85, 100)
    assert circulant_minhash(odd(spark, [])).count() == 0


def test_groups_of_the_given_documents(spark):
    got = entry_module.queries()["op11_minhash_near_dedup"](spark, FOLDER).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(documents(), 5, 85, 100)


def families(n, edits=1):
    """Two families of near copies that share three quarters of their words, dealt evenly."""
    rng = random.Random(9)
    common = [f"c{i}" for i in range(150)]
    heads = [[f"{name}{i}" for i in range(50)] for name in "xy"]
    rows = []
    for i in range(n):
        words = common + heads[i % 2]
        for _ in range(edits):
            words[rng.randrange(len(words))] = f"own{i}-{rng.random()}"
        rows.append((i, " ".join(words)))
    return rows


def test_comparisons_grow_in_proportion_to_a_family(spark, monkeypatch):
    compared = []
    plain = minhash._compare

    def counted(pairs, texts, size):
        seen = plain(pairs, texts, size)
        compared.append(seen.count())
        return seen

    monkeypatch.setattr(minhash, "_compare", counted)
    totals = []
    for n in (250, 1000):
        compared.clear()
        rows = families(n)
        got = circulant_minhash(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, 5, 85, 100)
        totals.append(sum(compared))
    assert totals[1] < 5 * totals[0] and totals[1] < 10 * 1000


def test_sets_told_apart_by_their_differences_only(spark, monkeypatch):
    tried = []
    plain = minhash._pairs_by_differences
    monkeypatch.setattr(minhash, "_pairs_by_differences", lambda *a: tried.append(1) or plain(*a))
    rows = families(300, edits=3)
    got = circulant_minhash(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, 5, 85, 100)
    assert tried


@pytest.mark.parametrize("join", [circulant_minhash, ngram_jaccard_join])
def test_texts_are_fetched_only_where_sketches_allow_a_link(spark, monkeypatch, join):
    compared = []
    plain = minhash._compare
    monkeypatch.setattr(minhash, "_compare", lambda *a: compared.append(a[0].count()) or plain(*a))
    common = " ".join(f"c{i}" for i in range(150))
    rows = [(i, common + "".join(f" own{i}-{j}" for j in range(50))) for i in range(40)]
    got = join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    # three fifths alike: they share buckets, and none is linked
    assert compared and sum(compared) == 0
    assert {(r.doc_id, r.component_id) for r in got} == {(i, i) for i in range(40)}


def with_a_passage(n, join):
    """Strangers with a passage in common, every tenth beside a copy that has one word changed or two."""
    rng = random.Random(3)
    # so much of the passage that strangers share buckets, and are no links
    shared, own = (150, 40) if join is circulant_minhash else (150, 35)
    common = [f"c{i}" for i in range(shared)]
    rows = []
    for i in range(n):
        words = common + [f"own{i}-{j}" for j in range(own)]
        rows.append((len(rows), " ".join(words)))
        if i % 10 == 0:
            for at in rng.sample(range(len(words)), rng.choice((1, 2))):
                words[at] = f"new{i}-{at}"
            rows.append((len(rows), " ".join(words)))
    return rows


@pytest.mark.parametrize(("join", "num", "den"), [(circulant_minhash, 85, 100), (ngram_jaccard_join, 8, 10)])
@pytest.mark.parametrize("common", [100_000, 20])
def test_strangers_with_a_passage_in_common_part_by_their_rarest_elements(spark, monkeypatch, join, num, den, common):
    fetched, tried = [], []
    plain, rarest = minhash._with_hubs, minhash._pairs_by_differences

    def counted(pairs, sets):
        if "_text" in sets.columns:
            fetched.append(pairs.count())
        return plain(pairs, sets)

    monkeypatch.setattr(minhash, "_with_hubs", counted)
    monkeypatch.setattr(minhash, "_pairs_by_differences", lambda *a: tried.append(1) or rarest(*a))
    monkeypatch.setattr(minhash, "COMMON", common, raising=False)
    rows = with_a_passage(400, join)
    got = join(spark.createDataFrame(rows, "doc_id long, text string"), threshold=(num, den)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, 5, num, den)
    # whole texts meet for the forty copies, not for each stranger and its hub
    assert tried and sum(fetched) < 200


def test_first_elements_of_linked_sets_meet():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    common = minhash.shingle_sets([" ".join(words[:9]).encode()], 1, minhash.WordHashes())[0]
    for num, den in ((85, 100), (8, 10), (9, 10)):
        run = minhash._rarest(1, num, den, common, np.arange(2, 11))
        texts = [" ".join(rng.sample(words, rng.randint(1, 60))) for _ in range(120)]
        texts += [" ".join(t.split()[rng.randint(0, 5) :]) or "w1" for t in texts]
        n = [len(set(t.split())) for t in texts]
        rows = list(range(len(texts)))
        batch = pa.RecordBatch.from_pydict({"_row": rows, "_component": rows, "_n": n, "_text": texts})
        firsts = [e for out in run(iter([batch])) for e in out.column("_elements").to_pylist()]
        sets = [set(t.split()) for t in texts]
        for x in range(len(texts)):
            for y in range(x):
                if den * len(sets[x] & sets[y]) >= num * len(sets[x] | sets[y]):
                    at = next((i, firsts[y].index(e)) for i, e in enumerate(firsts[x]) if e in firsts[y])
                    assert (num + den) * at[0] <= den * n[x] - num * n[y]
                    assert (num + den) * at[1] <= den * n[y] - num * n[x]


def test_sketches_differ_by_no_more_than_their_sets():
    rng = np.random.default_rng(8)
    for n, apart in ((0, 5), (300, 1), (300, 40), (5000, 700), (200_000, 9000)):
        numbers = np.unique(rng.integers(0, 1 << 63, n + apart, dtype=np.uint64))
        one, other = numbers[: n + apart // 2], np.concatenate([numbers[:n], numbers[n + apart // 2 :]])
        told = [np.frombuffer(minhash.sketch(s), np.uint8).astype(int) for s in (one, other)]
        assert np.abs(told[0] - told[1]).sum() <= len(np.setxor1d(one, other))


def test_buckets_full_of_strangers(spark):
    rows = near_copies(5, 120)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    # one band of one row: nearly everything shares a bucket with strangers
    got = circulant_minhash(df, bands=60, rows=1, threshold=(60, 100)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows, 5, 60, 100)


def test_coordinates_agree_as_often_as_sets_overlap():
    rng = np.random.default_rng(2)
    for share in (0.3, 0.6, 0.9):
        agree = []
        for _ in range(30):
            pool = np.unique(rng.integers(0, 2**63, 400).astype(np.uint64))[:390]
            both = int(390 * share)
            rest = (390 - both) // 2
            sets = [np.sort(np.concatenate([pool[:both], part])) for part in (pool[both : both + rest], pool[both + rest :])]
            x, y = minhash.signatures(sets, 120)
            agree.append(float((x == y).mean()))
        assert abs(np.mean(agree) - share) < 0.03
    x = np.arange(1 << 16, dtype=np.uint32) * np.uint32(65537)
    assert len(np.unique(minhash.permute(x.copy()))) == len(x)


# fill in the middle


def cut(doc, text, seed=1):
    text = text or ""
    hexed = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(hexed[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc, n, "plain", None, None, text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return doc, n, "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc, n, "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_cuts_match_slicing_and_come_back(spark):
    rows = ODD + [(100 + i, t) for i in range(60) for t in ("Größe <北京", "a\nb", "🙂<")] + documents()
    got = fill_in_middle(odd(spark, rows), carry=("text", "form", "n", "output"))
    assert got.columns == ["text", "form", "n", "output", "doc_id", "_n", "_form", "prefix_units", "middle_units", "_output"]
    got = got.withColumn("again", restored(F.col("_output"), F.col("_form"))).collect()
    assert Counter((r.doc_id, r._n, r._form, r.prefix_units, r.middle_units, r._output) for r in got) == Counter(
        cut(doc, text) for doc, text in rows
    )
    assert all(r.again == (r.text or "") for r in got)
    assert {r._form for r in got} == {"plain", "psm", "spm"}
    assert fill_in_middle(odd(spark, [])).count() == 0


def test_other_units_and_shares(spark):
    rows = [(i, "ab cd ef" if i % 2 else "abc") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = fill_in_middle(df, unit=r"\w\w(?:\s|$)", rate=100, spm_rate=100).collect()
    assert {(r.form, r.n) for r in got} == {("spm", 3), ("plain", None)}
    assert {r.form for r in fill_in_middle(df, rate=0).collect()} == {"plain"}


# periodic runs


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain_runs(words, exponent=4, least=6):
    found, seen = [], set()
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            end = i + q
            if end - start >= max(least, exponent * q) and (start, end) not in seen:
                seen.add((start, end))
                found.append((start, end - start, q))
            i += 1
    kept = [True] * len(words)
    for start, length, q in found:
        kept[start + q : start + length] = [False] * (length - q)
    return sorted(found, key=lambda r: (r[0], r[2])), " ".join(w for w, k in zip(words, kept) if k)


def repeating(seed, n=400):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        size, few = rng.choice((0, 1, 5, 6, 7, 30, 80, 300)), rng.choice((1, 2, 3, 5, 30))
        words = [f"w{rng.randrange(few)}" for _ in range(size)]
        if size > 6 and rng.random() < 0.5:
            a = rng.randrange(size)
            p = 1 + (size - a) // (3 + rng.randrange(8))
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(size)]
        rows.append((i, "\n ".join(words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_runs_match_brute_force(spark, seed):
    rows = [r for r in ODD if r[0] != 9] + [(9, "w " * 3000)] + repeating(seed) + [(900, "x y " * 20 + "x x x x x x x " + "x y " * 9)]
    got = periodic_runs(odd(spark, rows), carry=("runs", "n_words", "_text"))
    assert got.columns == ["runs", "n_words", "_text", "doc_id", "_n_words", "_runs", "collapsed"]

    def want(text):
        words = words_of(text)
        return (len(words), *map(str, plain_runs(words)))

    assert Counter(
        (r.doc_id, r._n_words, str([tuple(run) for run in r._runs]), r.collapsed) for r in got.collect()
    ) == Counter((doc, *want(text)) for doc, text in rows)
    assert periodic_runs(odd(spark, [])).count() == 0


def test_other_exponents():
    for exponent, least in ((2, 2), (3, 5), (5, 20)):
        texts = [text.encode().split() for _, text in repeating(exponent, 200)]
        for words, (runs, rest) in zip(texts, collapsed_lot(texts, exponent, least)):
            want, left = plain_runs([w.decode() for w in words], exponent, least)
            assert (runs, rest.decode()) == (want, left)


def test_extensions_on_the_grammar():
    rng = np.random.default_rng(1)
    for n, few in ((50, 2), (400, 2), (3000, 3), (3000, 1)):
        inner = rng.integers(0, few, n)
        inner[n // 2 : n // 2 + n // 4] = inner[: n // 4]
        words = np.concatenate([[few], inner, [few + 1]])
        i = rng.integers(1, n - 1, 300)
        j = np.minimum(i + rng.integers(1, n, 300), n)
        i, j = i[i < j], j[i < j]
        grammar = Grammar(words)

        def length(a, b, step):
            k = 0
            while words[a + step * k] == words[b + step * k]:
                k += 1
            return k

        assert grammar.extension(i, j).tolist() == [length(a, b, 1) for a, b in zip(i, j)]
        assert grammar.extension(i, j, back=True).tolist() == [length(a, b, -1) for a, b in zip(i, j)]


def test_runs_of_the_given_documents(spark):
    got = {r.doc_id: r for r in entry_module.queries()["op13_periodic_runs"](spark, FOLDER).collect()}
    planted = 0
    for doc, text in documents():
        words, h = words_of(text), zlib.crc32(str(doc).encode())
        g, n = h // 10, len(words_of(text))
        if h % 10 == 0 and n > 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            planted += 1
        runs, left = plain_runs(words)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
        r = got[doc]
        listed = "".join("%d,%d,%d\n" % run for run in runs)
        assert (r.n_words, r.n_runs, r.start, r.length, r.period) == (n, len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(left.encode()).hexdigest()
    assert planted and any(r.n_runs for r in got.values())


def test_repeats_of_odd_rows(spark):
    rows = with_repeats(spark.createDataFrame(ODD, "doc_id long, text string")).collect()
    assert [r.doc_id for r in rows] == [doc for doc, _ in ODD]


# check SQL


def test_query_matches_sql(spark):
    name = "op12_fill_in_middle"
    result = entry_module.queries()[name](spark, FOLDER)
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    expected = duck.sql(entry_module.oracle_sql()[name])
    columns = sorted(result.columns)
    assert columns == sorted(expected.columns)
    assert Counter(map(tuple, result.select(*columns).collect())) == Counter(
        expected.select(*columns).fetchall()
    )
