"""Secret scan: fixed patterns, and character Markov models compared by log-likelihood ratio.

Two first-order character models are trained from labelled samples: random strings (the values
that the fixed patterns find in all documents, and RANDOM_SAMPLES generated strings each of
base64, hex and upper-case digits) and ordinary identifiers (every long run of identifier
characters in all documents that no pattern covers, weighed by the chance that it is one: the
model is refitted until the secrets among the runs have left it). A run of at least MIN_RUN
characters is a secret if the random model explains it better by a margin, in total and per
character; of other runs the stretches for which that holds are. Runs that touch a match of a
pattern are judged by what the match leaves of them.

DataFrame functions only. A match's position is the running sum of the lengths of the gaps and
matches before it (``split`` and ``regexp_extract_all`` walk the text alike); the sums run over a
document's matches as rows, so a document with very many matches costs no more than a sort.
Texts are read once; only matches, runs and gap lengths are stored and shuffled. The models are
counts of character pairs, at most len(ALPHABET)**2 per class.

Defined results: a null text is an empty one and has no spans. Repeated rows are scanned each by
itself. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.shared import stored, table

#: Base patterns (fixed values, from the query contract): kind, pattern, least length and the
#: group that the length is measured on.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = (("assign", ASSIGN, 8, 2), ("access", "AKIA[A-Z0-9]+", 16, 0), ("hex", "[0-9a-f]+", 32, 0))
#: Cheap tests that hold for every text with a match that counts.
MAY_HOLD = {"assign": r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]""",
            "access": "AKIA[A-Z0-9]{12}", "hex": "[0-9a-f]{32}"}
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
RUN = "[A-Za-z0-9+/_=-]{%d,}"
TRAIN_RUN, MIN_RUN = 14, 20          # shortest run that trains the model of identifiers, that is judged
RANDOM_SAMPLES = 5000                # generated random strings of each form
DISCOUNT = 2                         # taken off each count of ordinary pairs at least: what a lone secret would add
ROUNDS, SETTLED = 30, 0.0005         # of refitting the ordinary model: at most, the share of runs that still moves
WEIGHT = 1024                        # runs are weighed in steps of 1 / WEIGHT
BACKOFF = 8.0                        # pseudo-counts of a character's overall frequency
LEAST_TOTAL, LEAST_MEAN = 12.0, 0.6  # log-likelihood ratio: of the run, per pair of characters


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Array of (length of the gap before the match, the match, the group's value)."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else hits
    zipped = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), values.alias("value"))
    return F.slice(zipped, 1, F.size(hits))


def found_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(row, doc_id) of each document, and its matches and runs with their positions.

    Spans: row, kind (base kinds and ``run``), start, end (code points, end exclusive) and value.
    Of a run that touches base spans what they leave of it is a run.
    """
    kinds = [*BASE, ("run", RUN % TRAIN_RUN, TRAIN_RUN, 0)]
    none = F.expr("array()").cast("array<struct<gap:int,hit:string,value:string>>")
    body = F.coalesce(docs[text], F.lit(""))
    held = docs.select(F.monotonically_increasing_id().alias("row"), docs[doc_id].alias("doc_id"), body.alias("text"))
    held = stored(held.select("row", "doc_id", *[
        (F.when(F.col("text").rlike(MAY_HOLD[kind]), _matches(F.col("text"), pattern, group)).otherwise(none)
         if kind in MAY_HOLD else _matches(F.col("text"), pattern, group)).alias(kind)
        for kind, pattern, _, group in kinds]), "matches")
    parts = [held.select("row", F.lit(kind).alias("kind"), F.posexplode(kind).alias("i", "m"),
                         F.lit(least).alias("least")) for kind, _, least, _ in kinds]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    sofar = Window.partitionBy("row", "kind").orderBy("i")
    size = F.length("m.hit")
    rows = (rows.withColumn("end", F.sum(F.col("m.gap").cast("long") + size).over(sofar))
            .where(F.length("m.value") >= F.col("least"))
            .select("row", "kind", (F.col("end") - size).alias("start"), "end", F.col("m.value").alias("value")))
    is_base = F.col("kind") != "run"
    by_start = Window.partitionBy("row").orderBy("start", "end")
    before = F.max(F.when(is_base, F.col("end"))).over(by_start)
    after = F.min(F.when(is_base, F.col("start"))).over(
        by_start.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    covered = ~is_base & (F.coalesce(before > F.col("start"), F.lit(False))
                          | F.coalesce(after < F.col("end"), F.lit(False)))
    spans = stored(rows.withColumn("covered", covered), "spans")
    whole = spans.where("not covered").drop("covered")
    return held.select("row", "doc_id"), whole.unionByName(stored(remainders(spans), "remainders"))


def remainders(spans: DataFrame) -> DataFrame:
    """What base spans leave of covered runs: a sweep over the starts and ends of both in each row."""
    spans = spans.where("kind <> 'run' or covered")
    is_run = F.col("kind") == "run"
    ends = F.explode(F.array(
        F.struct(F.col("start").alias("at"), F.lit(1).alias("step"), F.when(is_run, F.struct("start", "value")).alias("run")),
        F.struct(F.col("end").alias("at"), F.lit(-1).alias("step"), F.lit(None).alias("run"))))
    events = spans.select("row", is_run.alias("is_run"), ends.alias("e")).select("row", "is_run", "e.*")
    order = Window.partitionBy("row").orderBy("at")
    sofar = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = events.select(
        "row", "at", F.lead("at").over(order).alias("next"), F.last("run", ignorenulls=True).over(sofar).alias("run"),
        F.sum(F.when(F.col("is_run"), F.col("step")).otherwise(0)).over(sofar).alias("runs"),
        F.sum(F.when(F.col("is_run"), 0).otherwise(F.col("step"))).over(sofar).alias("bases"))
    left = swept.where("runs = 1 and bases = 0").where(F.col("next") - F.col("at") >= TRAIN_RUN)
    return left.select("row", F.lit("run").alias("kind"), F.col("at").alias("start"), F.col("next").alias("end"),
                       F.expr("substring(run.value, int(at - run.start) + 1, int(next - at))").alias("value"))


def random_strings(spark, samples: int = RANDOM_SAMPLES) -> DataFrame:
    """Generated labelled samples of the random class: base64, hex and upper-case base-36 like."""
    seed = F.sha2(F.concat(F.lit("sample"), F.col("id").cast("string")), 512)
    b64 = F.translate(F.base64(F.unhex(seed)), "\r\n", "")
    return spark.range(samples).select(F.explode(F.array(
        b64, F.substring(seed, 1, 64), F.translate(F.upper(b64), "+/=", ""))).alias("value"))


def pair_counts(values: DataFrame) -> dict[tuple[str, str], int]:
    """How often each pair of neighbouring characters occurs in ``value``, over all rows."""
    chars = F.split(F.col("value"), "")
    pairs = F.arrays_zip(F.slice(chars, F.lit(1), F.greatest(F.size(chars) - 1, F.lit(0))).alias("a"),
                         F.slice(chars, F.lit(2), F.greatest(F.size(chars) - 1, F.lit(0))).alias("b"))
    found = (values.select(F.explode(pairs).alias("p")).groupBy("p.a", "p.b").count())
    return {(r["a"], r["b"]): r["count"] for r in found.collect()}


def _conditional(pairs: dict[tuple[str, str], int]) -> dict[tuple[str, str], float]:
    """P(b | a): pair counts, backed off to how often b occurs at all (BACKOFF pseudo-counts)."""
    follows = {b: sum(pairs.get((a, b), 0) for a in ALPHABET) + 0.5 for b in ALPHABET}
    every = sum(follows.values())
    out = {}
    for a in ALPHABET:
        total = sum(pairs.get((a, b), 0) for b in ALPHABET)
        for b in ALPHABET:
            out[a, b] = (pairs.get((a, b), 0) + BACKOFF * follows[b] / every) / (total + BACKOFF)
    return out


def ratios(random: dict[tuple[str, str], int], ordinary: dict[tuple[str, str], int]) -> list[float]:
    """log P(b | a) under the random model less that under the ordinary one, for all pairs of ALPHABET."""
    p, q = _conditional(random), _conditional(ordinary)
    return [round(math.log(p[a, b]) - math.log(q[a, b]), 4) for a in ALPHABET for b in ALPHABET]


def _steps(value: Column) -> Column:
    """The pairs of neighbouring characters as places in the list that ``ratios`` returns, -1 for others."""
    places = F.transform(F.split(value, ""), _place)
    return F.zip_with(F.slice(places, F.lit(1), F.size(places) - 1), F.slice(places, F.lit(2), F.size(places) - 1),
                      lambda a, b: F.when((a >= 0) & (b >= 0), a * len(ALPHABET) + b).otherwise(-1))


def _gains(steps: Column, model: list[float]) -> Column:
    """Log-likelihood ratio of each step."""
    table_ = F.split(F.lit(" ".join(map(str, model))), " ").cast("array<double>")  # folded to a constant
    return F.transform(steps, lambda x: F.when(x >= 0, F.get(table_, x)).otherwise(0.0))


def _total(gains: Column) -> Column:
    return F.aggregate(gains, F.lit(0.0), lambda total, x: total + x)


def discounted(random: dict[tuple[str, str], int], ordinary: dict[tuple[str, str], float]) -> dict[tuple[str, str], float]:
    """``ordinary`` less what random strings among its runs would add.

    Their amount is read off the pairs that ordinary runs hardly use: the quarter of the random
    model's mass that ``ordinary`` holds least of.
    """
    mass, upto, level = sum(random.values()), 0, 0.0
    for level, n in sorted((ordinary.get(pair, 0) / n, n) for pair, n in random.items()):
        upto += n
        if 4 * upto >= mass:
            break
    out = {}
    for pair, n in ordinary.items():
        likely = level * random.get(pair, 0)
        less = likely + 2 * math.sqrt(likely) + DISCOUNT
        if n > less:
            out[pair] = n - less
    return out


def train(spans: DataFrame) -> list[float]:
    """The log-likelihood ratios of character pairs, from all spans and the generated samples.

    The uncovered runs are a mixture: mostly ordinary ones, and the secrets that no pattern finds.
    Each round scores every distinct run and counts its pairs by the chance that it is ordinary
    (expectation maximisation with the random model held), so secrets leave the ordinary model
    however many they are.
    """
    random = pair_counts(spans.where("kind <> 'run'").select("value").union(random_strings(spans.sparkSession)))
    # Each value once, so that a secret among them gains nothing from copies of its document.
    runs = spans.where("kind = 'run'").select("value").distinct()
    runs = stored(runs.select(_steps(F.col("value")).alias("steps")), "runs")

    def counted(weight: Column) -> tuple[float, dict[tuple[str, str], float]]:
        """The weight of all runs, and of their pairs; whole numbers of 1 / WEIGHT, so any order gives the same sums."""
        step = F.explode(F.concat(F.array(F.lit(-1)), "steps")).alias("step")
        found = (runs.withColumn("w", weight).where("w > 0").select("w", step).groupBy("step")
                 .agg(F.sum("w").alias("w")).collect())
        by = {r["step"]: r["w"] / WEIGHT for r in found}
        size = len(ALPHABET)
        return by.pop(-1, 0.0), {(ALPHABET[x // size], ALPHABET[x % size]): w for x, w in by.items()}

    every, pairs = counted(F.lit(WEIGHT).cast("long"))
    held, prior = every, 0.0
    for _ in range(ROUNDS):
        model = ratios(random, discounted(random, pairs))
        score_ = _total(_gains(F.col("steps"), model))
        now, pairs = counted(F.floor(WEIGHT / (1.0 + F.exp(score_ + prior))))
        moved, held = abs(now - held), now
        prior = math.log((every - held + 1) / (held + 1))
        if moved <= SETTLED * every:
            break
    return ratios(random, discounted(random, pairs))


def score(value: Column, model: list[float]) -> Column:
    """Log-likelihood ratio of a string: random against ordinary."""
    return _total(_gains(_steps(value), model))


def _place(char: Column) -> Column:
    """Index of a character in ALPHABET, -1 for others."""
    return F.call_function("instr", F.lit(ALPHABET), char) - 1


def _stretches(gains: Column) -> Column:
    """Array of (first, last + 1) of the stretches of steps that gain most beyond LEAST_MEAN each.

    One walk: a stretch begins where the sum is above 0 and ends at its highest sum, once the sum is 0 again
    or LEAST_TOTAL below; nothing of a later stretch is lost, as what follows the highest sum is a loss.
    """
    none = F.expr("cast(array() as array<struct<first:int,last:int>>)")

    def state(i, first, total, best, last, out):
        return F.struct(i.alias("i"), first.alias("first"), total.alias("total"), best.alias("best"),
                        last.alias("last"), out.alias("out"))

    def closed(s):
        found = F.array(F.struct(s["first"].alias("first"), s["last"].alias("last")))
        return F.when(s["best"] >= LEAST_TOTAL, F.concat(s["out"], found)).otherwise(s["out"])

    def step(s, x):
        i, total = s["i"] + 1, s["total"] + x - LEAST_MEAN
        over = (total <= 0) | (s["best"] - total >= LEAST_TOTAL)
        return F.when(over, state(i, i, F.lit(0.0), F.lit(0.0), i, closed(s))).when(
            total > s["best"], state(i, s["first"], total, total, i, s["out"])).otherwise(
            state(i, s["first"], total, s["best"], s["last"], s["out"]))

    zero = F.lit(0)
    return F.aggregate(gains, state(zero, zero, F.lit(0.0), F.lit(0.0), zero, none), step, closed)


def judged(spans: DataFrame, model: list[float]) -> DataFrame:
    """Base spans and what the models call random (kind ``markov``): whole runs, or else stretches of them.

    A stretch, the best of many, has to gain LEAST_TOTAL beyond LEAST_MEAN per pair.
    """
    base = spans.where("kind <> 'run'").select("row", "kind", "start", "end")
    runs = spans.where((F.col("kind") == "run") & (F.length("value") >= MIN_RUN))
    runs = runs.withColumn("gains", _gains(_steps(F.col("value")), model)).withColumn("score", _total(F.col("gains")))
    whole = (F.col("score") >= LEAST_TOTAL) & (F.col("score") >= LEAST_MEAN * F.size("gains"))
    every = F.array(F.struct(F.lit(0).alias("first"), F.size("gains").alias("last")))
    parts = F.filter(_stretches(F.col("gains")), lambda p: p["last"] - p["first"] + 1 >= MIN_RUN)
    found = runs.select("row", "start", F.explode(F.when(whole, every).otherwise(parts)).alias("p"))
    return base.unionByName(found.select(
        "row", F.lit("markov").alias("kind"), (F.col("start") + F.col("p.first")).alias("start"),
        (F.col("start") + F.col("p.last") + 1).alias("end")))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: counts of the base kinds, digest of the base spans, all spans as text."""
    rows, spans = found_spans(docs, doc_id, text)
    spans = judged(spans, train(spans))
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    said = F.concat_ws(":", "kind", "start", "end")
    each = spans.select("row", F.lit(None).cast(rows.schema["doc_id"].dataType).alias("doc_id"), "kind",
                        F.struct("start", order.alias("k"), "end", said.alias("said")).alias("span"))
    both = rows.withColumn("kind", F.lit(None).cast("string")).unionByName(each, allowMissingColumns=True)
    listed = F.sort_array(F.collect_list("span"))

    def joined(spans_: Column) -> Column:
        return F.array_join(F.transform(spans_, lambda s: s["said"]), ",")

    out = both.groupBy("row").agg(
        F.max_by("doc_id", F.when(F.col("kind").isNull(), 1)).alias("doc_id"),
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in KINDS], listed.alias("all"))
    base = F.filter(F.col("all"), lambda s: s["k"] < len(KINDS))
    return out.select("doc_id", *[f"n_{k}" for k in KINDS], F.sha2(joined(base), 256).alias("base_sha256"),
                      joined(F.col("all")).alias("spans"))


def op9_secret_scans(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
