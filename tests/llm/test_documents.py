"""Operators on single documents: rules, lines, tokens, languages, quality."""

from __future__ import annotations

import heapq
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_module
from tallywright.llm import language_id, rule_ensemble
from tallywright.llm.line_dedup import line_dedup
from tallywright.llm.packing import WordEncoder, pack, place, slots
from tallywright.llm.quality_rules import COMMON_WORDS, quality_rules

FOLDER = "/root/testdata/sf0.001"
TOKENS = public_tokenizers.path("word_bpe_49k.json")
ODD = [  # id, text, lang, source
    (1, None, "en", "a"), (2, "", None, None), (3, " \t\n ", "en", "a"), (4, "one", None, "a"),
    (5, "a b c " * 400, "xx", None), (6, "Größe ñ 北京 é   x y", "de", "a"),
    (7, "same line\nsame line\nother", "en", "a"), (7, "same line\nsame line\nother", "en", "a"),
    (None, "no id here", "en", "b"), (9, "w " * 30_000, "en", "b"),
]


def odd(spark, rows=ODD):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return df.selectExpr("*", "1 AS _row", "2 AS kept_", "3 AS n_lines", "4 AS length_", "5 AS _text")


def expected_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    at = defaultdict(list)
    for i in range(len(words) - 2):
        at[tuple(words[i : i + 3])].append(i)
    covered = {j for places in at.values() if len(places) > 1 for i in places for j in (i, i + 1, i + 2)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, again, len(covered)


def documents():
    return duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{FOLDER}/documents.parquet'").fetchall()


@pytest.mark.parametrize("rows", [ODD, None])
def test_base_counts_match_plain_counting(spark, rows):
    df = odd(spark) if rows else spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = Counter(
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        for r in quality_rules(df).collect()
    )
    want = Counter()
    for doc, text, *_ in rows or documents():
        n = expected_counts(text)
        want[(doc, *n, n[0] < 50 or 100 * n[4] > 50 * n[0])] += 1
    assert got == want


def test_many_repeated_windows_are_counted_like_few(spark):
    words = [f"w{i % 50}x{i % 7}" for i in range(3000)]
    text = " ".join(words + ["end"] + words[:200])
    row = quality_rules(odd(spark, [(1, text, "en", "a")])).first()
    assert (row.n_words, row.n_repeat_words) == (expected_counts(text)[0], expected_counts(text)[4])


def _distance(doc: dict, ref: dict) -> float:
    total = 0.0
    for bar in set(doc) | set(ref):
        p, q = doc.get(bar, 0.0), ref.get(bar, 0.0)
        m = (p + q) / 2
        total += sum(x * math.log2(x / m) for x in (p, q) if x > 0)
    return math.sqrt(max(total / 2, 0))


def test_word_distance_is_jensen_shannon(spark):
    rows = documents()
    sums, bags = defaultdict(Counter), {}
    for doc, text, lang, _ in rows:
        bags[doc] = Counter(w for w in re.findall(r"[^\x20\x09-\x0D]+", text or "") if w in COMMON_WORDS)
        sums[lang].update(bags[doc])
    share = lambda bag: {w: n / sum(bag.values()) for w, n in bag.items()}
    got = {r.doc_id: r.word_distance for r in quality_rules(spark.read.parquet(f"{FOLDER}/documents.parquet")).collect()}
    for doc, _, lang, _ in rows:
        want = _distance(share(bags[doc]), share(sums[lang])) if bags[doc] else 1.0
        assert got[doc] == pytest.approx(want, abs=1e-9)


def test_rules_keep_labelled_good_documents_and_reject_symbols(spark):
    folder = "/root/testdata/sf0.01"
    got = quality_rules(spark.read.parquet(f"{folder}/documents.parquet")).toPandas()
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{folder}/labels.parquet'").df()
    judged = got[~got.base_failed].merge(labels, on="doc_id")
    assert judged[judged.quality == 1].kept.mean() > 0.99
    assert judged[judged.quality == 0].kept.mean() < 0.3


def test_rules_lose_no_good_document_to_a_thin_histogram(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("quality = 1 and toxic = 0").select("doc_id")
    judged = quality_rules(docs).join(labels, "doc_id").where("not base_failed")
    assert judged.count() > 2000 and judged.where("not kept").count() == 0
    title = " ".join(f"Word{'abcdefghij'[i % 10]}{'klmnop'[i // 10]}" for i in range(60)).lower()
    many = " ".join([title] + [f"other{chr(97 + i // 26)}x{chr(97 + i % 26)}" for i in range(400)])
    rows = docs.select("doc_id", "text", "lang").unionByName(
        spark.createDataFrame([(-1, title, "en"), (-2, many, "en")], "doc_id long, text string, lang string")
    )
    got = {r.doc_id: r.kept for r in quality_rules(rows).where("doc_id < 0").collect()}
    assert got == {-1: True, -2: False}  # sixty words tell nothing, so many without a common one do


def test_line_dedup_by_hand(spark):
    rows = [(i, f"common\nown {i}\n\n common \nrare {i % 2}", "en", "h") for i in range(10)]
    rows += [(20, "common\nx", "en", None), (21, None, "en", "h"), (22, "", "en", "h")]
    rows += [(30 + i, "common", "en", "small") for i in range(3)]
    got = {r.doc_id: r for r in line_dedup(odd(spark, rows), max_ratio=0.7, min_pages=5).collect()}
    assert got[0].text == "own 0\n\nrare 0" and (got[0]._n_lines, got[0].n_dropped) == (4, 2)
    assert got[0].n_lines == 3  # the caller's column
    assert got[20].text == "common\nx" and got[21].text is None and got[22].text == ""
    assert got[30].text == "common"  # too few pages
    assert len(got) == len(rows)


def test_lines_of_small_hosts_go_by_their_ratio(spark):
    rows = [(i, f"shared\nown {i}", "en", "two") for i in range(2)] + [(9, "alone", "en", "one")]
    got = {r.doc_id: (r.text, r.n_dropped) for r in line_dedup(odd(spark, rows)).collect()}
    assert got == {0: ("own 0", 1), 1: ("own 1", 1), 9: ("alone", 0)}


def test_line_dedup_all_lines_gone_and_empty_table(spark):
    rows = [(i, "only", "en", None) for i in range(6)]
    assert {r.text for r in line_dedup(odd(spark, rows)).collect()} == {""}
    assert line_dedup(odd(spark, [])).count() == 0


@pytest.mark.parametrize("name", ["op2_preference_format", "op5_line_dedup", "op8_exact_dedup"])
def test_matches_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    got = entry_module.queries()[name](spark, FOLDER)
    columns = sorted(got.columns)
    want = duck.sql(entry_module.oracle_sql()[name])
    assert columns == sorted(want.columns)
    order = ", ".join(f'"{c}"' for c in columns)
    expected = duck.sql(f"SELECT {order} FROM ({entry_module.oracle_sql()[name]})").fetchall()
    assert Counter(map(repr, map(tuple, got.select(*columns).collect()))) == Counter(map(repr, expected))


def test_word_encoder_equals_the_tokenizer():
    texts = [t or "" for _, t, *_ in ODD] + [
        "It's 12 o'clock, DON'T... <|endoftext|> a<|startoftext|>b <|ENDOFTEXT|> x, É. ﬁ ΑΣ. ΑΣ", "İi. K, ª. ǅ,",
    ]
    plain = Tokenizer.from_file(TOKENS)
    want = [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]
    coder = WordEncoder(TOKENS)
    assert [ids.tolist() for ids in coder.encode(pa.array(texts, pa.string()))] == want
    assert [ids.tolist() for ids in coder.encode(pa.array(texts, pa.string()).slice(3, 4))] == want[3:7]
    assert coder.encode(pa.array([], pa.string())) == []


def test_word_encoder_that_forgets_equals_the_tokenizer():
    coder, plain = WordEncoder(TOKENS), Tokenizer.from_file(TOKENS)
    coder.words.most = coder.cores.most = 2_000  # a few words: generations turn with every lot
    texts = [text or "" for _, text, *_ in documents()[:60]]
    for low in range(0, 60, 5):
        got = coder.encode(pa.array(texts[low : low + 5], pa.string()))
        assert [ids.tolist() for ids in got] == [
            e.ids for e in plain.encode_batch(texts[low : low + 5], add_special_tokens=False)
        ]
    assert coder.words.aged


@pytest.mark.parametrize("rows", [ODD, None])
def test_packing_holds_every_token_once(spark, rows):
    df = odd(spark) if rows else spark.read.parquet(f"{FOLDER}/documents.parquet")
    pieces = pack(df, tokenizer=TOKENS, with_ids=True).collect()
    plain = Tokenizer.from_file(TOKENS)
    want = Counter()
    for doc, text, *_ in rows or documents():
        ids = plain.encode(text or "", add_special_tokens=False).ids + [1]
        for start in range(0, len(ids), 2048):
            want[(doc, start, np.array(ids[start : start + 2048], dtype="<u4").tobytes(), len(ids))] += 1
    assert Counter((p.doc_id, p.start, bytes(p.ids), p.doc_tokens) for p in pieces) == want
    assert all(zlib.crc32(p.ids) == p.ids_crc32 and len(p.ids) == 4 * p.length for p in pieces)
    by_sequence = defaultdict(list)
    for p in pieces:
        by_sequence[p.sequence_id].append((p.offset, p.length))
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    assert sorted(by_sequence) == list(range(len(by_sequence)))


def test_packing_of_nothing(spark):
    assert pack(odd(spark, []), tokenizer=TOKENS).count() == 0


def test_placing_is_exact_bounded_and_tight():
    rng = np.random.default_rng(3)
    for scale in (1, 1000):
        histogram = {int(n): int(c) * scale for n, c in zip(rng.integers(1, 65, 40), rng.integers(1, 9, 40), strict=True)}
        histogram[1] = 5000 * scale  # a third and more of all pieces
        patterns = place(histogram, 64)
        placed = Counter()
        for count, runs in patterns:
            assert sum(n * t for n, t in runs) <= 64
            for n, t in runs:
                placed[n] += count * t
        assert placed == Counter(histogram)
        tokens = sum(n * c for n, c in histogram.items())
        assert sum(c for c, _ in patterns) <= 1.02 * tokens / 64 + 1
        assert len(slots(patterns)) <= 3 * 64 * 12


def plain_shortest_pack_first(histogram, width):
    """Lengths longest first, one piece after another into the shortest pack, or a new one."""
    packs = []  # heap of used space
    for length in sorted(histogram, reverse=True):
        for _ in range(histogram[length]):
            used = heapq.heappop(packs) if packs and packs[0] + length <= width else 0
            heapq.heappush(packs, used + length)
    return len(packs)


@pytest.mark.parametrize("seed", range(6))
def test_placing_takes_as_few_packs_as_plain_shortest_pack_first(seed):
    rng = np.random.default_rng(seed)
    for width, top in ((64, 64), (256, 100), (2048, 2048)):
        lengths = Counter((1 + np.minimum(rng.geometric(3 / top, 3000), top - 1)).tolist())
        patterns = place(dict(lengths), width)
        want = plain_shortest_pack_first(lengths, width)
        assert sum(count for count, _ in patterns) <= 1.01 * want + 1


def test_tagger_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    lane = {k: v.astype(np.float64) for k, v in language_id._lanes(rng, 3).items()}
    codes = rng.integers(0, 256, (5, 4)).astype(np.uint8)
    outer = rng.normal(size=(5, 4, 3))
    loss = lambda: float((language_id._run(lane, codes) * outer).sum())
    trace = []
    language_id._run(lane, codes, trace)
    grads = language_id._back(lane, codes, trace, outer)
    for name in ("Uz", "Ur", "Un", "Gz", "Gr", "Gn"):
        spot = (int(codes[2, 1]), 1) if name[0] == "G" else (1, 2)
        lane[name][spot] += 1e-2
        up = loss()
        lane[name][spot] -= 2e-2
        down = loss()
        lane[name][spot] += 1e-2
        assert grads[name][spot] == pytest.approx((up - down) / 2e-2, rel=0.05, abs=2e-3)


def test_numbers_are_no_letters(spark):
    texts = {1: "½ ² Ⅷ ①", 2: "12 _ ...", 3: "½ a"}
    rows = [*texts.items(), (10, "some words"), (11, "some words")]
    df = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score > 0) for r in language_id.identify_language(df, steps=20).collect()}
    assert got[1] == got[2] == ("und", False) and got[3] == ("en", True)


def test_rare_languages_are_learned_and_repeated_rows_count_once(spark):
    rows = [(None, "the same words again and again", "en")] * 900
    rows += [(i, f"the cat and the dog number {i} went home", "en") for i in range(900)]
    rows += [(5000 + i, f"кот и собака {i} пошли домой", "ru") for i in range(8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.learn(df, doc_id="doc_id", text="text", lang="lang", sample=40, chars=200, hidden=8, steps=40)
    assert model.languages == ["en", "ru"]
    got = language_id.identify_language(df, sample=40, steps=40)
    assert {r.lang_pred for r in got.where("lang_pred = 'ru'").collect()} == {"ru"}
    assert got.where("doc_id >= 5000 and lang_pred <> 'ru'").count() == 0


def test_language_of_held_out_documents(spark):
    got = entry_module.queries()["op6_language_id"](spark, "/root/testdata/sf0.01").toPandas()
    want = duckdb.sql("SELECT doc_id, lang FROM '/root/testdata/sf0.01/documents.parquet'").df()
    both = got.merge(want, on="doc_id")
    assert len(both) == len(want)
    assert (both[both.held_out].lang == both[both.held_out].lang_pred).mean() > 0.95
    assert got.score.between(0, 1).all()


def test_language_edge_cases(spark):
    got = language_id.identify_language(odd(spark), steps=20).collect()
    assert len(got) == len(ODD)
    assert {r.lang_pred for r in got if r.doc_id in (1, 2, 3)} == {"und"}
    assert language_id.identify_language(odd(spark, [])).count() == 0
    unknown = odd(spark, [(1, "words", None, None)])
    assert [r.lang_pred for r in language_id.identify_language(unknown).collect()] == ["und"]


def test_whole_texts_are_labelled_beyond_a_window():
    tagger = language_id.ByteTagger(["a", "b"], 2)
    texts = [b"x" * 5, b"y" * 1000, b""]
    got = tagger.documents(texts, window=16, wide=8)
    for text, row in zip(texts, got, strict=True):
        parts = [text[i : i + 16] for i in range(0, len(text), 16)]
        total = np.zeros(2)
        for part in parts:
            codes = np.full((16, 1), 32, dtype=np.uint8)
            codes[: len(part), 0] = np.frombuffer(part, dtype=np.uint8)
            total += tagger.probabilities(codes)[: len(part), 0].sum(axis=0)
        assert row == pytest.approx(total / max(1, len(text)), abs=1e-5)


def test_quality_of_held_out_documents(spark):
    got = entry_module.queries()["op10_quality_classifier"](spark, "/root/testdata/sf0.01").toPandas()
    labels = duckdb.sql("SELECT doc_id, quality FROM '/root/testdata/sf0.01/labels.parquet'").df()
    both = got.merge(labels, on="doc_id")
    held = both[both.held_out]
    assert (held.predicted == held.quality).mean() > 0.95
    assert (got.predicted == (got.score >= 0.7)).all() and len(got) == 1000


def test_labelled_rows_are_drawn_once_each(spark, monkeypatch):
    rows = [(8, "the same good text")] * 400 + [(i, f"text {i} " * (1 + i % 30)) for i in range(100, 400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(8, 1)] + [(i, i % 2) for i in range(100, 400)], "doc_id long, quality int")
    seen, fit = [], rule_ensemble.fit
    monkeypatch.setattr(rule_ensemble, "fit", lambda x, y, **more: (seen.append(len(y)), fit(x, y, **more))[1])
    assert rule_ensemble.classify_quality(df, labels).count() == len(rows)
    assert seen[0] == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i in [8, *range(100, 400)])
    rule_ensemble.classify_quality(df, labels, sample=100).count()
    assert seen[1] < 250


def test_rules_compile_to_the_same_scores(spark):
    rng = np.random.default_rng(1)
    x = rng.random((400, 3))
    y = ((x[:, 0] > 0.3) & (x[:, 2] < 0.8)).astype(float)
    model = rule_ensemble.fit(x, y, trees=5)
    assert ((model.predict(x) > 0.5) == y).mean() > 0.95
    df = spark.createDataFrame(x.tolist(), "a double, b double, c double")
    got = [r[0] for r in df.select(model.column(["a", "b", "c"])).collect()]
    assert got == pytest.approx(model.predict(x).tolist())


def test_quality_edge_cases(spark):
    labels = spark.createDataFrame(
        [(1, 0), (4, 1), (7, 1), (7, 0), (None, 1), (5, None)], "doc_id long, quality int"
    )
    got = rule_ensemble.classify_quality(odd(spark), labels).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert rule_ensemble.classify_quality(odd(spark, []), labels).count() == 0
    none = rule_ensemble.classify_quality(odd(spark), labels.limit(0)).collect()
    assert {round(r.score, 6) for r in none} == {0.5}
