"""Quality rules as weak supervision.

Each rule votes good, bad or abstains on a document. Expectation-maximisation over the counts
of all vote patterns estimates how often each rule is right on good and on bad documents and
how common bad ones are. A document's verdict is its posterior probability of being good,
not that it passes every rule.

The corpus enters the estimate through one aggregate: the number of documents per vote
pattern, at most 3**rules rows whatever the corpus size. Features are computed from whole
texts in Arrow batches; nothing is shuffled but pattern counts.

Defined results: a null or empty text has no words, so it fails the base rules. Repeated rows
get the same verdict, an empty table gives an empty result, other columns pass through as they
are (added columns get underscores in front if their names are taken).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.shared import small_batches, stored, table, unused
from tessera.llm.words import SLICE_BYTES, Slice, mixed, run_hashes, slices

FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_upper_words", "n_marked_words", "n_stutters", "n_lines")

#: Bytes of ``[#*$%&|<>]`` (fixed value, from the query contract).
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = True

#: (name, numerator, denominator, good up to, bad from). Between the two the rule abstains.
RULES = (
    ("symbols", "n_symbols", "n_words", 0.02, 0.10),
    ("repeats", "n_repeat_words", "n_words", 0.10, 0.20),
    ("capitals", "n_upper_words", "n_words", 0.05, 0.30),
    ("marks", "n_marked_words", "n_words", 0.05, 0.25),
    ("stutter", "n_stutters", "n_words", 0.02, 0.15),
    ("lines", "n_dup_lines", "n_lines", 0.00, 0.50),
)
#: Rules of a different shape: mean word length within limits, number of words.
WORD_CHARS, FEW_WORDS, ENOUGH_WORDS = (2.5, 12.0), 10, 30
VOTES = tuple(r[0] for r in RULES) + ("word_length", "length")


def _pairs_within(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Masks: the key occurs twice or more; the key occurred earlier."""
    order = np.argsort(keys, kind="stable")
    s = keys[order]
    same = np.zeros(len(s), bool)
    same[1:] = s[1:] == s[:-1]
    again = np.zeros(len(s), bool)
    again[order] = same
    often = same.copy()
    often[:-1] |= same[1:]
    twice = np.zeros(len(s), bool)
    twice[order] = often
    return twice, again


def features(s: Slice) -> dict[str, np.ndarray]:
    """The counts of FEATURES for each text of the slice."""
    n, text = s.counts(), s.text_of_word()
    space = s.space()
    h = s.word_hashes(lower=False)
    salt = mixed(np.arange(1, len(s) + 1, dtype=np.uint64))

    def per_text(word_mask: np.ndarray) -> np.ndarray:
        return np.bincount(text[word_mask], minlength=len(s)).astype(np.int64)

    runs = run_hashes(h, 5)
    whole = text[4:] == text[: len(runs)] if len(runs) else np.zeros(0, bool)
    covered = np.zeros(len(h), bool)
    if whole.any():
        at = np.flatnonzero(whole)
        twice, _ = _pairs_within(mixed(runs[at]) ^ salt[text[at]])
        steps = np.zeros(len(h) + 1, np.int32)
        np.add.at(steps, at[twice], 1)
        np.add.at(steps, at[twice] + 5, -1)
        covered = np.cumsum(steps[:-1]) > 0

    # Lines: pieces between newlines and text edges that hold a word.
    breaks = np.flatnonzero(s.raw == 10)
    edges = np.unique(np.concatenate([breaks, s.offsets[1:] - 1, [-1]]))
    begin, end = edges[:-1] + 1, edges[1:] + 1
    newline = s.raw[end - 1] == 10 if len(end) else np.zeros(0, bool)
    end = end - newline
    words_in = np.searchsorted(s.starts, end) - np.searchsorted(s.starts, begin)
    begin, end = begin[words_in > 0], end[words_in > 0]
    line_text = np.searchsorted(s.offsets, begin, "right") - 1
    _, again = _pairs_within(s.span_hashes(begin, end, lower=False) ^ salt[line_text])

    upper = (s.raw >= 65) & (s.raw <= 90)
    lower = (s.raw >= 97) & (s.raw <= 122)
    sums = np.zeros((2, len(s.raw) + 1), np.int32)
    np.cumsum(upper, out=sums[0, 1:])
    np.cumsum(lower, out=sums[1, 1:])
    ups, lows = sums[0, s.ends] - sums[0, s.starts], sums[1, s.ends] - sums[1, s.starts]
    size = s.ends - s.starts
    last = _PUNCT[s.raw[s.ends - 1]]
    before = _PUNCT[s.raw[np.maximum(s.ends - 2, s.starts)]]
    stutter = np.zeros(len(h), bool)
    stutter[1:] = (h[1:] == h[:-1]) & (text[1:] == text[:-1])
    return {
        "n_words": n,
        "word_chars": s.per_text(~space & ((s.raw & 0xC0) != 0x80)),
        "n_symbols": s.per_text(_SYMBOL[s.raw]),
        "n_dup_lines": np.bincount(line_text[again], minlength=len(s)).astype(np.int64),
        "n_repeat_words": per_text(covered),
        "n_upper_words": per_text((ups > 1) & (lows == 0)),
        "n_marked_words": per_text(last & before),
        "n_stutters": per_text(stutter),
        "n_lines": np.bincount(line_text, minlength=len(s)).astype(np.int64),
    }


def with_features(docs: DataFrame, text: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with the columns of FEATURES; also their names in the result."""
    names = dict(zip(FEATURES, unused(docs, *FEATURES)))
    place = docs.columns.index(text)
    schema = T.StructType(docs.schema.fields + [T.StructField(c, T.LongType()) for c in names.values()])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in slices(batch.column(place), SLICE_BYTES):
                part = batch.slice(s.first, len(s))
                found = features(s)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *(pa.array(found[c]) for c in FEATURES)],
                    names=[f.name for f in schema.fields])

    return docs.mapInArrow(add, schema), names


def votes(names: dict[str, str]) -> dict[str, F.Column]:
    """1 good, -1 bad, 0 abstains, for each of VOTES."""
    out = {}
    for name, top, bottom, good, bad in RULES:
        share = F.col(names[top]) / F.greatest(F.col(names[bottom]), F.lit(1))
        out[name] = F.when(share >= bad, -1).when(share <= good, 1).otherwise(0)
    n = F.col(names["n_words"])
    mean = F.col(names["word_chars"]) / F.greatest(n, F.lit(1))
    out["word_length"] = F.when(n == 0, 0).when(mean.between(*WORD_CHARS), 1).otherwise(-1)
    out["length"] = F.when(n < FEW_WORDS, -1).when(n >= ENOUGH_WORDS, 1).otherwise(0)
    return out


def _pattern(names: dict[str, str]) -> F.Column:
    """The votes of a row as one number, a ternary digit for each rule."""
    total = F.lit(0)
    for i, vote in enumerate(votes(names).values()):
        total = total + (vote + 1) * F.lit(3 ** i)
    return total.cast("int")


def base_failed(names: dict[str, str]) -> F.Column:
    n = F.col(names["n_words"])
    return (n < 10) | (100 * F.col(names["n_repeat_words"]) > 20 * n)


#: What is expected of a rule beforehand: it is right on nearly all good documents, but sees only
#: some of the bad ones; each is bad in its own way. It counts as much as so many documents seen.
RIGHT_ON_GOOD, RIGHT_ON_BAD, GOOD_SHARE = 0.97, 0.3, 0.9
PRIOR_ROWS, PRIOR_SHARE = 10, 0.02


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 300, tolerance: float = 1e-9
        ) -> tuple[float, np.ndarray, np.ndarray]:
    """Expectation-maximisation over vote patterns (rows of -1, 0, 1) and their counts.

    Returns the share of good documents and, for each rule, the probability that its vote is
    right on a good and on a bad document. An abstention says nothing. The prior (PRIOR_ROWS
    documents and PRIOR_SHARE of those counted) keeps the two classes what they are called: without
    it the second class can settle on any split of the good documents, short ones say.
    """
    counts = counts.astype(float)
    prior = PRIOR_ROWS + PRIOR_SHARE * counts.sum()
    expected = np.tile([[RIGHT_ON_GOOD], [RIGHT_ON_BAD]], (1, patterns.shape[1]))
    share, right = GOOD_SHARE, expected.copy()
    for _ in range(rounds):
        good = posterior(patterns, share, right)
        before = share, right.copy()
        for k, weight in enumerate((good * counts, (1 - good) * counts)):
            said_good = ((patterns == 1) * weight[:, None]).sum(0)
            said_bad = ((patterns == -1) * weight[:, None]).sum(0)
            right[k] = ((said_good, said_bad)[k] + expected[k] * prior) / (said_good + said_bad + prior)
        share = float((good @ counts + GOOD_SHARE * prior) / (counts.sum() + prior))
        if abs(share - before[0]) + np.abs(right - before[1]).max() < tolerance:
            break
    return share, right, posterior(patterns, share, right)


def posterior(patterns: np.ndarray, share: float, right: np.ndarray) -> np.ndarray:
    """Probability of good for each pattern."""
    good = np.log(share) + (np.log(right[0]) * (patterns == 1) + np.log(1 - right[0]) * (patterns == -1)).sum(1)
    bad = np.log(1 - share) + (np.log(right[1]) * (patterns == -1) + np.log(1 - right[1]) * (patterns == 1)).sum(1)
    return 1 / (1 + np.exp(np.clip(bad - good, -700, 700)))


def label_model(featured: DataFrame, names: dict[str, str]) -> dict[int, float]:
    """Posterior of each vote pattern that occurs (at most 3**len(VOTES)), from all rows."""
    rows = featured.groupBy(_pattern(names).alias("p")).count().collect()
    if not rows:
        return {}
    rows.sort(key=lambda r: r["p"])
    codes = np.array([r["p"] for r in rows])
    patterns = codes[:, None] // 3 ** np.arange(len(VOTES)) % 3 - 1
    _, _, good = fit(patterns, np.array([r["count"] for r in rows]))
    return dict(zip(codes.tolist(), good.tolist()))


def judged(featured: DataFrame, names: dict[str, str], model: dict[int, float], threshold: float = 0.5
           ) -> DataFrame:
    """Adds ``posterior`` (good), ``base_failed`` and ``kept`` under free names."""
    p, b, k = unused(featured, "posterior", "base_failed", "kept")
    if model:
        lookup = F.create_map(*[F.lit(x) for pair in sorted(model.items()) for x in pair])
        good = F.element_at(lookup, _pattern(names))
    else:
        good = F.lit(None).cast("double")
    return (featured.withColumn(p, good).withColumn(b, base_failed(names))
            .withColumn(k, ~F.col(b) & (F.coalesce(F.col(p), F.lit(0.0)) >= threshold)))


def keep_good(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents whose posterior is at least one half and that pass the base rules.

    Two passes over ``docs``: one for the pattern counts, one that filters.
    """
    small_batches(docs.sparkSession)
    featured, names = with_features(docs, text)
    model = label_model(with_features(docs.select(text), text)[0], dict(zip(FEATURES, FEATURES)))
    marked = judged(featured, names, model)
    return marked.where(F.col(marked.columns[-1])).select(*[F.col(f"`{c}`") for c in docs.columns])


def op7_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    featured, names = with_features(docs)
    featured = stored(featured.drop("text"), "quality")
    marked = judged(featured, names, label_model(featured, names))
    return marked.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "posterior")
