"""Operators on groups of documents: copies, links, mixtures, licences, conversations, pipeline."""

from __future__ import annotations

import hashlib
import importlib
import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from tallywright.llm import licenses, mixing
from tallywright.llm.chat import preference_pairs
from tallywright.llm.components import connected_components
from tallywright.llm.exact_dedup import ContentTable, exact_dedup
from tallywright.llm.ngram_join import bands, ngram_jaccard_join, shingle_set, signatures

FOLDER = "/root/testdata/sf0.001"


def docs(spark, rows, extra=True):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.selectExpr("*", "7 AS keep_id", "8 AS _row", "9 AS component_id", "'x' AS _text") if extra else df


# exact copies


@pytest.mark.parametrize("bucket_bytes", [1 << 20, 40])
def test_exact_copies_like_a_dictionary(spark, bucket_bytes):
    rows = [(i, ["a", "b " * 30, "", None, "É"][i % 5] if i % 3 else f"text {i % 40}") for i in range(200)]
    rows += [(5, "a"), (5, "a"), (None, "a"), (None, "lonely"), (999, "long " * 20_000)]
    rows += [(1000 + i, "hot") for i in range(100)]
    got = exact_dedup(docs(spark, rows), carry=("keep_id",) if bucket_bytes > 40 else (), bucket_bytes=bucket_bytes, fan_out=3)
    got = [r.asDict() for r in got.select("doc_id", "group_size", "kept", "text_sha256", F.col("doc_id").alias("d")).collect()]
    groups = defaultdict(list)
    for doc, text in rows:
        groups[hashlib.sha256((text or "").encode()).hexdigest()].append(doc)
    assert Counter((r["doc_id"], r["text_sha256"]) for r in got) == Counter(
        (doc, sha) for sha, ids in groups.items() for doc in ids
    )
    for sha, ids in groups.items():
        own = [r for r in got if r["text_sha256"] == sha]
        kept = [r["doc_id"] for r in own if r["kept"]]
        largest = max((i for i in ids if i is not None), default=None)
        assert kept == [largest] and {r["group_size"] for r in own} == {len(ids)}


def test_exact_copies_of_nothing(spark):
    assert exact_dedup(docs(spark, [])).count() == 0


def test_content_table_settles_equal_hashes_by_content():
    table = ContentTable()
    assert [table.first(5, c, k) for k, c in enumerate((b"x", b"y", b"x", b"y", b"z"))] == [0, 1, 0, 1, 4]
    assert [table.first(h, b"%d" % h, 10 + h) for h in range(3000)] == [10 + h for h in range(3000)]
    assert table.first(1234, b"1234", -1) == 1244


# n-gram join


def brute(rows, size, num, den):
    def shingles(text):
        words = (text or "").encode().lower().split()
        k = min(size, len(words))
        return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if words else frozenset()

    sets = [(doc, shingles(text)) for doc, text in rows]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, x) in enumerate(sets):
        for j in range(i):
            y = sets[j][1]
            if x and y and den * len(x & y) >= num * len(x | y):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc, _) in enumerate(sets):
        least[find(i)].append(doc)
    return Counter(
        (doc, len(s), min((d for d in least[find(i)] if d is not None), default=None))
        for i, (doc, s) in enumerate(sets)
    )


def near_copies(seed, n=150):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.choice((4, 9, 15, 60, 200)))] for _ in range(6)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for i in range(n):
        words = list(rng.choice(bases))
        for _ in range(rng.choice((0, 0, 1, 1, 2, 3, 6))):
            at = rng.randrange(len(words))
            words[at : at + rng.choice((0, 1))] = [rng.choice(vocabulary)]
        if rng.random() < 0.2:
            words += passage
        if rng.random() < 0.1:
            words = [rng.choice(vocabulary) for _ in range(50)] + passage
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize(("size", "num", "den", "seed"), [(3, 90, 100, 1), (5, 8, 10, 2), (1, 6, 10, 3)])
def test_links_match_brute_force(spark, size, num, den, seed):
    rows = near_copies(seed)
    rows += [(500, None), (501, ""), (502, " \n"), (503, "one"), (504, "ONE"), (505, "one two"), (506, "two one")]
    rows += [(3, rows[3][1]), (None, rows[3][1]), (None, "alone here"), (507, "long " * 5000), (508, "Long " * 5000)]
    got = ngram_jaccard_join(docs(spark, rows), size=size, threshold=(num, den), carry=("component_id", "_row"))
    assert got.columns[:2] == ["component_id", "_row"]
    plain = ngram_jaccard_join(docs(spark, rows), size=size, threshold=(num, den)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in plain) == brute(rows, size, num, den)
    kept = Counter(r.component_id for r in plain if r.kept and r.n_shingles)
    assert set(kept.values()) == {1}


def test_links_of_nothing(spark):
    assert ngram_jaccard_join(docs(spark, [])).count() == 0


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(4)
    for num, den in ((9, 10), (8, 10)):
        for n in (1, 5, 9, 10, 11, 40, 333):
            base = np.unique(rng.integers(0, 2**63, n + 200).astype(np.uint64))[:n]
            for cut in range(n // 8 + 1):
                other = np.sort(np.concatenate([base[cut:], rng.integers(0, 2**63, cut // 2).astype(np.uint64)]))
                inter = n - cut
                if den * inter >= num * (n + len(other) - inter):
                    assert set(signatures(base, num, den)) & set(signatures(other, num, den))
    tops, most = bands(9, 10)
    assert tops[:10].tolist() == [1, 2, 3, 4, 5, 6, 7, 8, 10, 12] and most[8:10].tolist() == [1, 1]


def test_shingles_lower_only_ascii():
    assert len(shingle_set("A b É".encode(), 3)) == 1
    assert (shingle_set("A B".encode(), 3) == shingle_set("a b".encode(), 3)).all()
    assert (shingle_set("É x".encode(), 3) != shingle_set("é x".encode(), 3)).all()


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 300)] + [(7, 7)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(300)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# mixing


def test_rates_reach_reachable_targets(spark):
    rng = np.random.default_rng(2)
    rows = [(int(n), [float(p), float(1 - p)]) for n, p in zip(rng.integers(1, 900, 300), rng.random(300), strict=True)]
    stats = spark.createDataFrame(rows, "_n long, _p array<double>")
    rate, report = mixing.solve(stats, ["a", "b"], {"a": 0.6, "b": 0.4}, 0.0, None)
    got = stats.select("_n", "_p", rate.alias("r")).collect()
    total = np.sum([r._n * r.r * np.array(r._p) for r in got], axis=0)
    assert total == pytest.approx(report["wanted"], rel=1e-4) and min(r.r for r in got) >= 0


def test_infeasible_targets_settle_at_the_least_squares_point(spark):
    # one kind of document only: the best rate is the same for all
    stats = spark.createDataFrame([(10, [0.8, 0.2])] * 20, "_n long, _p array<double>")
    rate, report = mixing.solve(stats, ["a", "b"], {"a": 0.0, "b": 1.0}, 0.0, None)
    rates = {round(r[0], 6) for r in stats.select(rate).collect()}
    assert len(rates) == 1 and min(rates) >= 0


def least_squares(n, p, wanted, least, metric):
    """The rates of least weighted miss, by many small steps."""
    r = np.maximum(1.0, least)
    for _ in range(50_000):
        r = np.maximum(least, r - p @ (metric @ ((r * n) @ p - wanted)))
    return r


@pytest.mark.parametrize("floor,whole", [(0.0, ()), (0.0, ("a",)), (1.0, ())])
def test_rates_are_those_of_least_squares(spark, floor, whole):
    rng = np.random.default_rng(5)
    p = rng.dirichlet([0.6, 0.3, 0.2], 200)
    n = rng.integers(1, 900, 200)
    stats = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(n, p, strict=True)], "_n long, _p array<double>")
    rate, report = mixing.solve(stats, ["a", "b", "c"], {"a": 0.2, "b": 0.1, "c": 0.7}, floor, 1.5 * n.sum(), whole)
    least = np.where((p.argmax(axis=1) == 0) & bool(whole), np.maximum(floor, 1.0), floor)
    got = stats.select("_n", "_p", rate.alias("r")).collect()
    assert all(r.r >= 1 for r in got if whole and np.argmax(r._p) == 0) and min(r.r for r in got) >= floor
    metric = mixing._inverse(p.T @ (p * n[:, None]))
    best = least_squares(n, p, np.array(report["wanted"]), least, metric)
    miss = lambda total: (total - report["wanted"]) @ metric @ (total - report["wanted"])
    reached = np.sum([r._n * r.r * np.array(r._p) for r in got], axis=0)
    assert reached == pytest.approx(report["after"], rel=1e-9)
    within = 1.02 if floor == 0 and not whole else 3  # the others are out of reach: steps end near the least squares
    assert miss(reached) <= within * miss((best * n) @ p) + 1e-6 * n.sum()


def plain_posteriors(texts, domains, temper=0.6, most=64):
    """Naive Bayes over binned statistics and marker words, one text at a time."""
    names = sorted(set(domains.values()))
    sizes = Counter(domains.values())
    largest = max(names, key=lambda d: (sizes[d], d))
    split = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in texts.items()}
    marks = []
    for name in names:
        if name == largest:
            continue
        inside, outside = Counter(), Counter()
        for i, d in domains.items():
            (inside if d == name else outside).update({w.lower() for w in split.get(i, [])})
        gains = {w: math.log((a + 1) / (outside[w] + 1)) * math.sqrt(a) for w, a in inside.items() if a >= 5}
        marks.append({w for w, g in sorted(gains.items(), key=lambda e: (-e[1], e[0])) if g > 3})
        marks[-1] = set(sorted(marks[-1], key=lambda w: (-gains[w], w))[:most])
    bins = {}
    for i, words in split.items():
        joined, n = "".join(words), len(words)
        values = [n, len(joined) / n if n else 0, len(regex.findall(r"[^\p{L}\p{N}.,;:'\-]", joined)) / max(1, len(joined)),
                  len(regex.findall(r"\p{Lu}", joined)) / max(1, len(joined)), len(set(words)) / n if n else 0]
        values += [sum(w.lower() in m for w in words) / n if n else 0 for m in marks]
        edges = [*mixing.EDGES.values(), *[mixing.MARK_EDGES] * len(marks)]
        bins[i] = [sum(v > e for e in each) for v, each in zip(values, edges, strict=True)]
    table = np.ones((len(edges), 8, len(names)))
    for i, d in domains.items():
        for stat, b in enumerate(bins.get(i, [])):
            table[stat, b, names.index(d)] += 1
    total = table.sum(axis=1, keepdims=True)
    logs, prior = np.log(table / total), np.log(total[0, 0] / total[0, 0].sum())
    found = {}
    for i, each in bins.items():
        score = prior + temper * sum(logs[stat, b] for stat, b in enumerate(each))
        found[i] = np.exp(score - score.max()) / np.exp(score - score.max()).sum()
    return names, found


def test_posteriors_equal_plain_naive_bayes(spark):
    got = entry_module.queries()["op1_mixing"](spark, FOLDER).collect()
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{FOLDER}/documents.parquet'").fetchall())
    domains = {r.doc_id: r.domain for r in mixing.domain_of(spark.read.parquet(f"{FOLDER}/labels.parquet")).collect()}
    names, want = plain_posteriors(texts, domains)
    for r in got:
        assert [r[f"p_{d}"] for d in names] == pytest.approx(want[r.doc_id], abs=1e-9)


def test_marker_words_are_whole_words(spark):
    rows = [(i, f"classified number {i}") for i in range(20)] + [(100 + i, f"classic number {i}") for i in range(20)]
    df = docs(spark, rows)
    labels = spark.createDataFrame([(i, "low" if i < 100 else "good") for i, _ in rows], "doc_id long, domain string")
    got = mixing.mix(df, labels, {"good": 0.5, "low": 0.5}).collect()
    assert all((r.p_low > 0.8) == (r.doc_id < 100) for r in got)


def test_targets_out_of_reach_are_warned_of(spark):
    df = docs(spark, [(1, "some words here"), (2, "some words here")])
    labels = spark.createDataFrame([(1, "good"), (2, "low")], "doc_id long, domain string")
    report = {}
    with pytest.warns(UserWarning, match="not reached"):
        mixing.mix(df, labels, {"good": 1.0}, report=report)
    assert report["domains"] == ["good", "low"] and report["wanted"][1] == 0 < report["after"][1]


def test_mix_moves_labelled_domains(spark):
    folder = "/root/testdata/sf0.01"
    got = entry_module.queries()["op1_mixing"](spark, folder).toPandas()
    labels = duckdb.sql(f"SELECT * FROM '{folder}/labels.parquet'").df().merge(got, on="doc_id")
    assert len(got) == 1000 and (got.rate >= 0).all()
    good, low = labels[(labels.quality == 1) & (labels.toxic == 0)], labels[(labels.quality == 0)]
    assert good.p_good.mean() > 0.8 > 0.4 > low.p_good.mean()
    assert good.rate.mean() > low.rate.mean()
    share = lambda d: (got.rate * got.n_tokens * got[f"p_{d}"]).sum() / (got.rate * got.n_tokens).sum()
    assert share("good") == pytest.approx(0.9, abs=0.03)


def test_mix_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "a good text of words"), (3, "a good text of words"), (4, "### $$$ %%%"), (None, "x"), (9, "w " * 30_000)]
    df = docs(spark, rows).withColumn("rate", F.lit("mine"))
    labels = spark.createDataFrame([(3, "good"), (4, "low"), (4, None), (None, "low"), (77, "low")], "doc_id long, domain string")
    got = mixing.mix(df, labels, {"good": 0.5, "low": 0.5}).collect()
    assert len(got) == len(rows) and {r.rate for r in got if r.doc_id in (1, 2)} == {1.0}
    assert len({r.copies for r in got if r.doc_id == 3}) == 1
    assert mixing.mix(df.limit(0), labels, {"good": 1.0}).count() == 0
    alone = mixing.mix(df, labels.limit(0), {"good": 1.0}).collect()
    assert len(alone) == len(rows) and {round(r.p_unknown, 9) for r in alone} == {1.0}
    floored = mixing.mix(df, labels, {"good": 0.9, "low": 0.1}, floor=1.0, carry=("rate",))
    assert floored.columns[0] == "rate" and floored.where("copies < 1").count() == 0


# licences


def test_licences_and_inheritance(spark):
    mit, gpl = licenses.TEMPLATES["MIT"][0], licenses.TEMPLATES["GPL-3.0"][0]
    rows = [
        ("a/LICENSE", mit), ("a/x.py", "code"), ("a/b/c/y.py", "code"), ("a/b/COPYING", gpl),
        ("a/b/z.py", f"code\n// {mit}\nmore"), ("q/w.py", "code"), ("LICENSE.txt", "nothing known"),
        (None, "code"), ("a/null.py", None), ("a/b/d/e.py", ""), ("a/x.py", "code"), ("ab/x.py", "code"),
        ("deep/" * 30 + "f.py", "w " * 30_000 + "\n" + gpl),
    ]
    df = spark.createDataFrame(rows, "path string, text string").selectExpr("*", "1 AS license", "2 AS _dir")
    got = [(r.path, r.license, r.origin, r.from_dir) for r in licenses.scan_licenses(df).collect()]
    want = [
        ("a/LICENSE", "MIT", "file", None), ("a/x.py", "MIT", "inherited", "a"), ("a/b/c/y.py", "GPL-3.0", "inherited", "a/b"),
        ("a/b/COPYING", "GPL-3.0", "file", None), ("a/b/z.py", "MIT", "header", None), ("q/w.py", None, "none", None),
        ("LICENSE.txt", None, "none", None), (None, None, "none", None), ("a/null.py", "MIT", "inherited", "a"),
        ("a/b/d/e.py", "GPL-3.0", "inherited", "a/b"), ("a/x.py", "MIT", "inherited", "a"), ("ab/x.py", None, "none", None),
        ("deep/" * 30 + "f.py", "GPL-3.0", "header", None),
    ]
    assert Counter(got) == Counter(want)
    assert licenses.scan_licenses(df.limit(0)).count() == 0


def test_licence_of_the_root_reaches_all(spark):
    df = spark.createDataFrame([("LICENSE", licenses.TEMPLATES["MIT"][0]), ("x/y/z.py", "code"), ("top.py", "code")], "path string, text string")
    assert {(r.path, r.license) for r in licenses.scan_licenses(df).collect()} == {("LICENSE", "MIT"), ("x/y/z.py", "MIT"), ("top.py", "MIT")}


def test_cosines_match_plain_arithmetic(spark):
    idf, unseen, vectors = licenses.weights(licenses.TEMPLATES)
    texts = ["Licensed under the MIT terms", "copyright copyright all rights reserved 2020 someone", "license"]
    df = spark.createDataFrame([("LICENSE", t) for t in texts], "_path string, _text string")
    for row in licenses.scored(df, licenses.TEMPLATES, 0.0).collect():
        bag = Counter(licenses._terms(row._text))
        values = {t: n * idf.get(t, unseen) for t, n in bag.items()}
        norm = sum(v * v for v in values.values()) ** 0.5
        best = max(sum(v * vec.get(t, 0) for t, v in values.items()) / norm for vec in vectors.values())
        assert row._score == pytest.approx(best, abs=1e-5)


def test_whole_licence_texts_and_unknown_licence_files(spark):
    rows, want = [], {}
    for name in ("GPL-3.0", "GPL-2.0", "LGPL-2.1", "LGPL-3.0", "Apache-2.0", "MIT", "MPL-2.0", "CC0-1.0"):
        text = licenses.WHOLE[name].replace("<owner>", "Jane Okafor").replace("<year>", "2021")
        for path, body in (
            (f"{name}/LICENSE", "Riverbank tools, by Jane Okafor\n\n" + text.replace("\n\n", "\n")),
            (f"{name}/half/COPYING", text[: len(text) // 2]), (f"{name}-source/x.py", f"{text}\ncode = 1"),
        ):
            rows.append((path, body))
            want[path] = name
    own = "Nobody but the members of our rowing club can use these files, on weekdays, and only in good weather."
    rows += [("MIT/shut/LICENSE", own), ("MIT/shut/in/x.py", "code"), ("MIT/open/x.py", "code")]
    want |= {"MIT/shut/LICENSE": "unknown", "MIT/shut/in/x.py": "unknown", "MIT/open/x.py": "MIT"}
    got = licenses.scan_licenses(spark.createDataFrame(rows, "path string, text string")).collect()
    assert {r.path: r.license for r in got} == want


# conversations


def test_common_turns_become_the_prompt(spark):
    rows = [
        (1, "chosen", 0, "user", "hi"), (1, "rejected", 0, "user", "hi"),
        (1, "chosen", 1, "assistant", "yes"), (1, "rejected", 1, "assistant", "no"), (1, "rejected", 2, "user", "hm"),
        (2, "chosen", 0, "user", "a"), (2, "rejected", 0, "user", "a"), (3, "chosen", 0, None, None),
        (None, "chosen", 0, "user", "x"), (4, "other", 0, "user", "x"), (5, "chosen", 3, "user", "t"), (5, "chosen", 3, "assistant", "t"),
        (5, "rejected", 3, "assistant", "t"),
    ]
    df = spark.createDataFrame(rows, "pair_id long, side string, turn long, role string, text string").withColumn("prompt", F.lit(1))
    got = {r.pair_id: r for r in preference_pairs(df).collect()}
    assert set(got) == {1, 2, 3, 5}
    one = got[1]
    assert one.prompt == "<|user|>\nhi<|end|>\n" and one.n_common == 1 and not one.tie
    assert [one.chosen[s.start : s.end] for s in one.chosen_mask] == ["yes<|end|>"]
    assert [one.rejected[s.start : s.end] for s in one.rejected_mask] == ["no<|end|>"]
    assert got[2].tie and (got[2].chosen, got[2].rejected, got[2].chosen_mask) == ("", "", [])
    assert got[3].chosen == "<||>\n<|end|>\n" and got[3].rejected == ""
    assert got[5].n_common == 1 and got[5].chosen == "<|user|>\nt<|end|>\n" and got[5].rejected == ""
    assert preference_pairs(df.limit(0)).count() == 0


# the pipeline


def test_pipeline_stages_on_their_own_inputs(spark):
    pipeline = importlib.import_module("corpus_pipeline")
    assert [n for n, _ in pipeline.STAGES] == ["quality_rules", "line_dedup", "near_duplicates", "mixing", "packing"]
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet")
    held, out_schema = {"documents": frame.collect()}, {}
    for name, stage in pipeline.STAGES:
        out = stage(spark, frame, FOLDER)
        held[name], out_schema[name] = out.collect(), out.schema
        if name != "packing":
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            frame = spark.createDataFrame(held[name], out.schema)
    ids = {name: Counter(r.doc_id for r in rows) for name, rows in held.items()}
    from tallywright.llm.quality_rules import quality_rules

    verdict = {r.doc_id for r in quality_rules(spark.read.parquet(f"{FOLDER}/documents.parquet")).where("kept").collect()}
    assert set(ids["quality_rules"]) == verdict < set(ids["documents"])
    assert ids["line_dedup"] == ids["quality_rules"]
    want = brute([(r.doc_id, r.text) for r in held["line_dedup"]], 5, 8, 10)
    assert set(ids["near_duplicates"]) == {c for _, _, c in want} | {d for d, n, _ in want if n == 0}
    gone = set(ids["near_duplicates"]) - set(ids["mixing"])
    from tallywright.llm.mixing import domain_of, mix

    was = spark.createDataFrame(held["near_duplicates"], out_schema["near_duplicates"])
    rated = mix(was, domain_of(spark.read.parquet(f"{FOLDER}/labels.parquet")), pipeline.TARGETS, whole=("good",)).collect()
    assert ids["mixing"] == Counter({r.doc_id: r.copies for r in rated if r.copies})
    assert gone == {r.doc_id for r in rated if r.copies == 0}
    assert not any(r.p_good >= max(r.p_low, r.p_toxic) for r in rated if r.doc_id in gone)  # the likely good stay
    whole = defaultdict(int)
    for r in held["packing"]:
        whole[r.doc_id] += r.length
    tokens = {r.doc_id: r.doc_tokens for r in held["packing"]}
    assert all(whole[d] == tokens[d] * n for d, n in ids["mixing"].items())


def test_pipeline_of_nothing(spark):
    pipeline = importlib.import_module("corpus_pipeline")
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES[:-1]:
        out = stage(spark, frame, FOLDER)
        frame = spark.createDataFrame(out.collect(), out.schema)
    assert pipeline.STAGES[-1][1](spark, frame, FOLDER).count() == 0


def test_stage_results_outlive_later_stages(spark):
    pipeline = importlib.import_module("corpus_pipeline")
    stages = dict(pipeline.STAGES)
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(40)
    held = stages["quality_rules"](spark, frame, FOLDER)
    stages["line_dedup"](spark, frame, FOLDER)
    assert held.count() <= 40 and len(held.collect()) == held.count()


# names of results among the pipeline's columns


@pytest.mark.parametrize("stage", ["quality", "near_duplicates", "mixture"])
def test_stages_carry_columns_named_like_their_results(spark, stage):
    import corpus_pipeline

    run = getattr(corpus_pipeline, stage)
    given = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60)
    more = given.selectExpr("*", "1 AS kept", "2 AS n_words", "3 AS component_id", "4 AS copies", "5 AS rate")
    got = run(spark, more, FOLDER)
    assert got.columns == more.columns
    rows = got.collect()
    assert rows and {tuple(r)[-5:] for r in rows} == {(1, 2, 3, 4, 5)}
