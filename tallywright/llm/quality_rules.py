"""Quality rules: base counts and the Jensen-Shannon distance to language references.

A document is compared with its language's reference in two histograms: the
classes of its characters and its most common words.  The references are sums
over all documents of a language, so one long pass gathers them and a second one
decides.  Everything is a column expression; what is shuffled is a histogram per
language and task.

Defined results: a null text counts as empty; a document without words has zero
counts, NULL distances and fails the base rules.  A null language, or one without
words, is compared with the reference of all documents.  Each histogram judges only where it has
mass: the classes from ``guard`` words and ``class_guard`` characters on, the common words from
``word_guard`` words on if ``common_guard`` of them are common ones, or if so few of so many
are (under a twentieth) that their lack tells.  Equal rows get equal results,
row by row; other columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.llm.common import words_of, written

#: Function words of the four languages, as text.
COMMON_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "was", "on", "with", "as",
    "be", "by", "this", "are", "or", "an", "at", "from", "have", "not", "he", "they",
    "der", "die", "und", "das", "den", "von", "zu", "mit", "ist", "für", "auf", "ein", "eine",
    "nicht", "im", "sich", "des", "dem", "er", "es",
    "le", "la", "les", "de", "et", "un", "une", "du", "en", "que", "qui", "dans", "pour", "sur",
    "pas", "au", "avec", "est", "ce",
    "el", "los", "las", "y", "una", "por", "con", "para", "del", "se", "no", "su", "al",
)
#: Character classes but for the first, which is all the rest (lower-case ASCII letters).
CLASSES = {
    "capital": r"\p{Lu}",
    "letter": r"[\p{L}&&[^\p{Lu}a-z]]",
    "digit": r"\p{N}",
    "stop": r"""[.,;:!?'"()\-]""",
    "symbol": r"""[^\p{L}\p{N}.,;:!?'"()\-]""",
}
SYMBOLS = "[#*$%&|<>]"
#: So many repeated windows of a text are looked up by scanning their list.
FEW = 32
EVERY = "\u0000every"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _removed(text: Column, pattern: str) -> Column:
    return (F.length(text) - F.length(F.regexp_replace(text, pattern, ""))).cast("long")


def base_counts(df: DataFrame, text: str) -> DataFrame:
    """``df`` with the struct ``_q``: the base counts, class counts and common-word counts."""
    words = F.col("_words")
    lines = F.filter(
        F.split(F.coalesce(F.col(text), F.lit("")), "\n"),
        lambda line: line.rlike(r"[^\x20\x09-\x0D]"),
    )
    hashes = F.col("_hashes")
    pairs = F.zip_with(hashes, F.slice(hashes, F.lit(2), F.size(hashes)), lambda a, b: F.xxhash64(a, b))
    grams = F.zip_with(pairs, F.slice(hashes, F.lit(3), F.size(hashes)), lambda ab, c: F.xxhash64(ab, c))
    steps = df.withColumn("_words", words_of(F.col(text)))
    steps = steps.withColumn("_hashes", F.transform(words, lambda w: F.xxhash64(w)))
    steps = steps.withColumns({
        "_joined": F.array_join(words, ""),
        # the last two have no third word
        "_grams": F.slice(grams, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))),
        "_common": F.sort_array(F.filter(words, lambda w: w.isin(*COMMON_WORDS))),
        "_lines": lines,
    })
    steps = steps.withColumns({
        "_rest": F.regexp_replace("_joined", "[a-z]+", ""),
        "_kinds": F.array_distinct("_common"),
        "_again": F.size(F.array_distinct("_grams")) < F.size("_grams"),
    })
    # Windows found twice.  A few of them are looked up directly; many (a text that repeats
    # itself throughout) are found by sorting all windows with their places.
    ordered, twice, placed = F.col("_ordered"), F.col("_twice"), F.col("_placed")
    steps = steps.withColumn("_ordered", F.when(F.col("_again"), F.sort_array("_grams")))
    steps = steps.withColumn(
        "_twice",
        F.array_distinct(
            F.filter(ordered, lambda g, i: F.coalesce(g == F.get(ordered, i + 1), F.lit(False)))
        ),
    )
    steps = steps.withColumn(
        "_placed",
        F.when(
            F.size(twice) > FEW,
            F.sort_array(
                F.transform("_grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))
            ),
        ),
    )
    same = lambda e, k: F.coalesce(e["g"] == F.get(placed, k)["g"], F.lit(False))
    few = F.array_compact(
        F.transform("_grams", lambda g, i: F.when(F.array_contains(twice, g), i))
    )
    many = F.sort_array(
        F.transform(
            F.filter(placed, lambda e, j: same(e, j - 1) | same(e, j + 1)), lambda e: e["i"]
        )
    )
    steps = steps.withColumn("_at", F.when(F.col("_again"), F.coalesce(many, few)))
    at = F.col("_at")
    # each window brings three words, less where the next one begins within it
    covered = F.coalesce(
        F.aggregate(
            F.transform(at, lambda p, j: F.least(F.lit(3), F.coalesce(F.get(at, j + 1) - p, F.lit(3)))),
            F.lit(0).cast("long"),
            lambda total, gain: total + gain,
        ),
        F.lit(0).cast("long"),
    )
    starts = F.transform("_kinds", lambda w: F.array_position("_common", w))
    steps = steps.withColumn("_starts", starts)
    starts = F.col("_starts")
    counts = F.transform(
        starts,
        lambda p, j: F.coalesce(F.get(starts, j + 1), F.size("_common") + 1).cast("long") - p,
    )
    classes = [_removed(F.col("_rest"), pattern) for pattern in CLASSES.values()]
    stats = F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.length("_joined").cast("long").alias("word_chars"),
        _removed(F.col("_rest"), SYMBOLS).alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        F.array((F.length("_joined") - F.length("_rest")).cast("long"), *classes).alias("classes"),
        F.col("_kinds").alias("kinds"),
        counts.alias("counts"),
    )
    return steps.withColumn("_q", stats).drop(
        "_words", "_hashes", "_joined", "_grams", "_common", "_lines", "_rest", "_kinds", "_again",
        "_ordered", "_twice", "_placed", "_at", "_starts",
    )


def references(measured: DataFrame, lang: str) -> DataFrame:
    """Per language, and for all documents: shares of character classes and of common words.

    One row per language with two maps of bounded size (the classes, COMMON_WORDS).
    """
    bars = F.concat(
        F.transform(
            F.col("_q.classes"),
            lambda n, i: F.struct(F.lit("c").alias("kind"), i.cast("string").alias("bar"), n.alias("n")),
        ),
        F.zip_with(
            F.col("_q.kinds"), F.col("_q.counts"),
            lambda w, n: F.struct(F.lit("w").alias("kind"), w.alias("bar"), n.alias("n")),
        ),
    )
    sums = (
        measured.select(F.coalesce(F.col(lang), F.lit(EVERY)).alias("ref"), F.explode(bars).alias("b"))
        .groupBy("ref", "b.kind", "b.bar").agg(F.sum("b.n").alias("n"))
    )
    every = sums.groupBy("kind", "bar").agg(F.sum("n").alias("n")).withColumn("ref", F.lit(EVERY))
    each = sums.where(F.col("ref") != EVERY).unionByName(every).where("n > 0")
    totals = each.groupBy("ref", "kind").agg(F.sum("n").alias("total"))
    shares = each.join(totals, ["ref", "kind"]).withColumn("share", F.col("n") / F.col("total"))
    entry = F.struct("bar", "share")
    listed = lambda kind: F.map_from_entries(
        F.array_sort(F.collect_list(F.when(F.col("kind") == kind, entry)))
    )
    return shares.groupBy("ref").agg(
        listed("c").alias("_class_ref"), listed("w").alias("_word_ref")
    )


def js_terms(counts: Column, total: Column) -> tuple[Column, Column]:
    """Sum of the divergence's terms over the bars a document has, and their reference mass.

    ``counts``: array of structs (n, q), q the reference share of a bar; ``total``: a column
    with the sum of n, computed before, so that it is not summed again for each bar.
    """
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))

    def term(e: Column) -> Column:
        p, q = e["n"] / total, e["q"]
        return part(p, (p + q) / 2) + part(q, (p + q) / 2)

    own = F.filter(counts, lambda e: e["n"] > 0)
    return (
        F.aggregate(own, F.lit(0.0), lambda a, e: a + term(e)),
        F.aggregate(own, F.lit(0.0), lambda a, e: a + e["q"]),
    )


def js_distance(inside: Column, seen: Column) -> Column:
    """Jensen-Shannon distance, base 2, 0 to 1: bars a document lacks add half their share."""
    return F.sqrt(F.greatest((inside + (1 - seen)) / 2, F.lit(0.0)))


def quality_rules(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    keep: tuple[str, ...] = ("doc_id",),
    guard: int = 50,
    class_guard: int = 100,
    word_guard: int = 100,
    common_guard: int = 20,
    max_class_distance: float = 0.35,
    max_word_distance: float = 0.75,
) -> DataFrame:
    """Counts, distances and verdict of each row, with the columns ``keep``.

    ``kept`` is false where the base rules fail (``base_failed``) or where the characters lie
    further than ``max_class_distance`` or the common words further than ``max_word_distance``
    from the language reference, each with the mass that its guards ask for.
    """
    names = list(dict.fromkeys((*keep, lang, text)))
    base = docs.select(*[F.col(c) if c in docs.columns else F.lit(None).cast("string").alias(c) for c in names])
    wanted = list(dict.fromkeys(keep))
    # the caller's columns travel in a struct, so that their names cannot clash
    base = base.select(
        F.struct(*wanted).alias("_row"),
        F.col(lang).cast("string").alias("_lang"), F.col(text).alias("_text"),
    )
    measured = written(base_counts(base, "_text").drop("_text"), "quality-counts")
    refs = written(references(measured, "_lang"), "quality-references")
    known = refs.select(F.col("ref").alias("_lang")).withColumn("_known", F.lit(True))
    placed = measured.join(known, "_lang", "left").withColumn(
        "ref", F.when(F.col("_known"), F.col("_lang")).otherwise(EVERY)
    )
    return _judged(placed.join(refs, "ref", "left"), wanted, (guard, class_guard, word_guard, common_guard), max_class_distance, max_word_distance)


def _judged(df: DataFrame, keep: list[str], guards: tuple[int, ...], max_class: float, max_word: float) -> DataFrame:
    guard, class_guard, word_guard, common_guard = guards
    share = lambda ref, bar: F.coalesce(F.element_at(F.col(ref), bar), F.lit(0.0))
    classes = F.transform(
        F.col("_q.classes"),
        lambda n, i: F.struct(n.alias("n"), share("_class_ref", i.cast("string")).alias("q")),
    )
    words = F.zip_with(
        F.col("_q.kinds"), F.col("_q.counts"),
        lambda w, n: F.struct(n.alias("n"), share("_word_ref", w).alias("q")),
    )
    summed = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda t, n: t + n)
    bars = df.withColumns({
        "_classes": classes, "_common": words,
        "_n_classes": summed(F.col("_q.classes")), "_n_common": summed(F.col("_q.counts")),
    })
    n_words = F.col("_q.n_words")
    for kind, ref in (("_class", "_class_ref"), ("_word", "_word_ref")):
        bars_of, total = {"_class": ("_classes", "_n_classes"), "_word": ("_common", "_n_common")}[kind]
        inside, seen = js_terms(F.col(bars_of), F.col(total))
        bars = bars.withColumns({f"{kind}_in": inside, f"{kind}_seen": seen}).withColumn(
            f"{kind}_js",
            F.when(
                (F.col(total) > 0) & F.col(ref).isNotNull(),
                js_distance(F.col(f"{kind}_in"), F.col(f"{kind}_seen")),
            ),
        )
    # a document of many words and no common one is as far as can be
    bars = bars.withColumn("_word_js", F.coalesce("_word_js", F.when(n_words > 0, F.lit(1.0))))
    failed = (n_words < 50) | (100 * F.col("_q.n_repeat_words") > 50 * n_words)
    n_common = F.col("_n_common")
    telling = (n_words >= word_guard) & ((n_common >= common_guard) | (20 * n_common < n_words))
    far = (n_words >= guard) & (
        ((F.col("_n_classes") >= class_guard) & F.coalesce(F.col("_class_js") > max_class, F.lit(False)))
        | (telling & F.coalesce(F.col("_word_js") > max_word, F.lit(False)))
    )
    return bars.select(
        *[F.col("_row")[c].alias(c) for c in keep],
        *[F.col("_q")[c].alias(c) for c in STATS],
        F.col("_class_js").alias("class_distance"),
        F.col("_word_js").alias("word_distance"),
        failed.alias("base_failed"),
        (~failed & ~far).alias("kept"),
    )
