"""Mixing sources to target weights.

Token weights of the cells source x language x topic are raked to the marginals in turn (iterative proportional
fitting); a cell's weight is how often its records are wanted. Records are then drawn with these probabilities, a record
by a hash of its id, and the probabilities of each source are calibrated on a histogram of what a draw would give, so
that the sizes drawn meet the targets more closely than independent draws would.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.functions.text import blank_to_null
from loomspan.operators.skew import lookup
from loomspan.scratch import Scratch

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed pattern of that vocabulary: how text is cut before byte pairs are merged.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
STEPS = 4096
MAX_SOURCES = 1000
MAX_CELLS = 2_000_000
#: More cells than these are joined without a broadcast.
MOST_SENT = 100_000
_encoders: dict[str, object] = {}


def encoder(path: str):
    """The tokenizer of a rank file, one per process."""
    if path not in _encoders:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encoders[path] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


def _sizes(path: str, columns: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        for batch in batches:
            n = [len(e.encode_ordinary(t)) if t else 0 for t in batch.column(columns).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:columns], pa.array(n, pa.int64())], [*batch.schema.names[:columns], "tokens"])

    return run


def token_counts(rows: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """rows with `tokens` in place of the last column, a text; 0 for null."""
    keep = rows.schema.fields[:-1]
    return rows.mapInArrow(_sizes(tokenizer, len(keep)), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep) + ", tokens long")


@dataclass
class Fit:
    """Wanted copies per cell, and how near the marginals came."""

    copies: np.ndarray
    total: float
    rounds: int
    worst: dict[str, float] = field(default_factory=dict)


def filled(copies: np.ndarray, tokens: np.ndarray, cap: float, goal: float, plain: float) -> float:
    """The factor by which copies, none then over the cap, give the goal in tokens; plain is the one without a cap. If the
    goal can't be met, the one that brings all to the cap."""
    if not len(copies) or copies.max() * plain <= cap:
        return plain
    order = np.argsort(-copies)
    c, t = copies[order], tokens[order]
    rest = np.cumsum((c * t)[::-1])[::-1]
    factor = np.divide(goal - cap * (np.cumsum(t) - t), rest, out=np.zeros(len(c)), where=rest > 0)
    fits = (factor * c <= cap) & (rest > 0)
    return max(float(factor[fits.argmax()]), 0.0) if fits.any() else cap / max(c[c > 0].min(initial=np.inf), 1e-300)


def rake_cells(tokens: np.ndarray, places: list[np.ndarray], targets: list[np.ndarray], cap: np.ndarray, total: float, rounds: int = 200, close: float = 1e-6) -> Fit:
    """Fit weights of cells to one target share vector per axis: source, language, topic. places[axis] has each cell's
    value on that axis; values number as the targets do.

    cap[source]: most copies of a record. Axes are fitted in turn, the source last, so that its shares are the ones that
    hold where not all can. Cells at their cap stay there; the rest of the source takes up what they can't.
    """
    copies = np.ones(len(tokens))
    limit = cap[places[0]]
    sums = lambda axis: np.bincount(places[axis], copies * tokens, len(targets[axis]))
    of = np.split(np.argsort(places[0], kind="stable"), np.cumsum(np.bincount(places[0], minlength=len(cap)))[:-1])
    fit = Fit(copies, total, 0)
    for fit.rounds in range(1, rounds + 1):
        before = copies
        for axis in (1, 2, 0):
            now = sums(axis)
            factor = np.divide(targets[axis] * total, now, out=np.zeros(len(now)), where=now > 0)
            if axis == 0:
                factor = np.array([filled(copies[at], tokens[at], c, goal * total, f) for at, c, goal, f in zip(of, cap, targets[0], factor, strict=True)])
            copies = np.minimum(copies * factor[places[axis]], limit)
        if np.abs(copies - before).max(initial=0) < close:
            break
    fit.copies = copies
    for name, axis in (("source", 0), ("language", 1), ("topic", 2)):
        fit.worst[name] = float(np.abs(sums(axis) / max(total, 1e-9) - targets[axis]).max(initial=0))
    return fit


def rake(tokens: np.ndarray, targets: list[np.ndarray], cap: np.ndarray, total: float, rounds: int = 200, close: float = 1e-6) -> Fit:
    """rake_cells of a whole table tokens[source, language, topic]."""
    fit = rake_cells(tokens.ravel(), [x.ravel() for x in np.indices(tokens.shape)], targets, cap, total, rounds, close)
    fit.copies = fit.copies.reshape(tokens.shape)
    return fit


def rake_table(cells: DataFrame, share: dict[str, float], cap: dict[str, float], total: float, scratch: Scratch, rounds: int = 200, close: float = 1e-6) -> tuple[DataFrame, Fit]:
    """rake_cells for cells (source, lang, topic, t) that the driver can't hold, in the same steps: a table with `copies`.

    Sums by axis are aggregated where the cells lie and looked up there; the driver holds a row per source."""
    spark, total = cells.sparkSession, float(total)
    share, cap = {s: float(x) for s, x in share.items()}, {s: float(x) for s, x in cap.items()}
    goal = spark.createDataFrame([(s, cap[s]) for s in share], "source string, cap double")
    state = scratch.save(cells.join(F.broadcast(goal), "source").withColumn("copies", F.lit(1.0)))  # at most MAX_SOURCES rows
    all_t = float(cells.agg(F.sum("t")).first()[0] or 0)
    nothing = Fit(np.zeros(0), total, 0)
    if not all_t:
        return state, nothing
    natural = {axis: scratch.save(cells.groupBy(axis).agg((F.sum("t") / F.lit(all_t)).alias("want"))) for axis in ("lang", "topic")}
    fit = nothing
    for fit.rounds in range(1, rounds + 1):
        moved = state.withColumn("before", F.col("copies"))
        for axis in ("lang", "topic"):
            now = scratch.save(moved.groupBy(axis).agg(F.sum(F.col("copies") * F.col("t")).alias("now")))
            factor = natural[axis].join(now, axis).select(axis, F.when(F.col("now") > 0, F.col("want") * total / F.col("now")).otherwise(0.0).alias("factor"))
            moved = lookup(moved, factor, axis).withColumn("copies", F.least(F.col("copies") * F.col("factor"), F.col("cap"))).drop("factor")
            moved = scratch.save(moved)
        factors = _filled_table(moved, share, total)
        table = spark.createDataFrame(list(factors.items()), "source string, factor double")
        moved = moved.join(F.broadcast(table), "source").withColumn("copies", F.least(F.col("copies") * F.col("factor"), F.col("cap"))).drop("factor")
        state = scratch.save(moved, old=state)
        if (state.agg(F.max(F.abs(F.col("copies") - F.col("before")))).first()[0] or 0.0) < close:
            break
        state = state.drop("before")
    reached = {r.source: r.n for r in state.groupBy("source").agg(F.sum(F.col("copies") * F.col("t")).alias("n")).collect()}
    fit.worst["source"] = max((abs(reached.get(s, 0.0) / max(total, 1e-9) - share[s]) for s in share), default=0.0)
    for name, axis in (("language", "lang"), ("topic", "topic")):
        off = state.groupBy(axis).agg(F.sum(F.col("copies") * F.col("t")).alias("now")).join(natural[axis], axis)
        fit.worst[name] = float(off.agg(F.max(F.abs(F.col("now") / F.lit(max(total, 1e-9)) - F.col("want")))).first()[0] or 0.0)
    return state.drop("before"), fit


def _filled_table(state: DataFrame, share: dict[str, float], total: float) -> dict[str, float]:
    """By source the factor of `filled`: cells that a factor brings to the cap are fixed there, and what is missing is asked of
    the others, until no further cell is fixed; each step is one aggregation."""
    spark, factors, fixed = state.sparkSession, {}, None
    while True:
        if not factors:
            part = state.withColumn("capped", F.lit(False))
        else:
            now = spark.createDataFrame(list(factors.items()), "source string, factor double")
            part = state.join(F.broadcast(now), "source").withColumn("capped", F.col("copies") * F.col("factor") > F.col("cap"))
        rows = part.groupBy("source").agg(
            F.sum(F.when(~F.col("capped"), F.col("copies") * F.col("t"))).alias("open"), F.sum(F.when(F.col("capped"), F.col("cap") * F.col("t"))).alias("full"),
            F.count_if("capped").alias("n"), F.min(F.when(F.col("copies") > 0, F.col("copies"))).alias("least"), F.max("cap").alias("cap"),
        ).collect()
        count = {r.source: r.n for r in rows}
        if count == fixed:
            return factors
        fixed = count
        for r in rows:
            missing = share[r.source] * total - (r.full or 0.0)
            if r.open:
                factors[r.source] = max(missing / r.open, 0.0)
            else:  # all are at the cap
                factors[r.source] = r.cap / r.least if r.least and missing > 0 else factors.get(r.source, 0.0)


def largest_total(sizes: np.ndarray, shares: np.ndarray, cap: np.ndarray) -> float:
    """The largest total of which every source can still give its share."""
    able = (shares > 0) & (sizes > 0)
    return float((cap[able] * sizes[able] / shares[able]).min(initial=np.inf)) if able.any() else 0.0


class Mixture:
    """A sample of documents (id, source, lang, topic, text) near the target shares (source, target_share, max_repeats).
    Documents with `tokens` in place of `text` are measured already (token_counts).

    Names count trimmed and lower-cased. Documents of null or unlisted sources aren't drawn; null languages and topics
    are values of their own. Every language and topic is raked to its own marginal, its share of the known sources'
    tokens. The driver holds the cells that aren't empty, up to max_cells; more are fitted in a table. Targets of over
    MAX_SOURCES sources are an error. Shares of sources without tokens are spread over the others. `total`: tokens wanted;
    by default the largest of which every source can give its share. max_repeats counts whole copies; null means 1.
    Repeated target rows count once, the largest share. Documents of no tokens are drawn like any other of their cell.

    `sample` has (id, source, tokens, copies) of the documents drawn; `report` a row per source named by targets or
    documents with the tokens available and drawn, the share wanted and reached; `marginals` the same per language and
    topic of the listed sources.
    """

    def __init__(self, documents: DataFrame, targets: DataFrame, scratch: Scratch, *, total: float | None = None, tokenizer: str = TOKENIZER, max_cells: int = MAX_CELLS) -> None:
        spark = documents.sparkSession
        name = lambda c: F.lower(blank_to_null(c))
        measured = "text" not in documents.columns
        rows = documents.where("id is not null").select("id", name("source").alias("source"), F.coalesce(name("lang"), F.lit("")).alias("lang"), F.coalesce(F.col("topic").cast("string"), F.lit("")).alias("topic"), "tokens" if measured else "text")
        sized = scratch.save(rows if measured else token_counts(rows, tokenizer))
        goals = targets.select(name("source").alias("source"), "target_share", "max_repeats").where("source is not null").groupBy("source").agg(F.max("target_share").alias("share"), F.max("max_repeats").alias("cap")).orderBy("source").limit(MAX_SOURCES + 1).collect()
        if len(goals) > MAX_SOURCES:
            raise ValueError("too many sources for one mixture")
        sources = [g.source for g in goals]
        known = sized.where(F.col("source").isin(sources)) if sources else sized.limit(0)
        grouped = scratch.save(known.groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("t")))
        by_source = {r.source: float(r.t) for r in grouped.groupBy("source").agg(F.sum("t").alias("t")).collect()}  # at most MAX_SOURCES rows
        all_tokens, size = sum(by_source.values()), np.array([by_source.get(s, 0.0) for s in sources] or [0.0])
        cap = np.array([np.floor(1.0 if g.cap is None else max(g.cap, 0)) for g in goals] or [0.0])
        share = np.array([max(g.share or 0.0, 0.0) for g in goals] or [0.0])
        share = np.where((size > 0) & (cap > 0), share, 0)
        share = share / share.sum() if share.sum() else share
        total = largest_total(size, share, cap) if total is None else total
        found = grouped.limit(max_cells + 1).toArrow()  # a row per cell
        if found.num_rows <= max_cells:
            found = found.sort_by([(c, "ascending") for c in ("source", "lang", "topic")])
            tokens = found["t"].to_numpy().astype(float)
            coded = {c: found[c].combine_chunks().dictionary_encode() for c in ("lang", "topic")}
            number = {x: i for i, x in enumerate(sources)}
            places = [np.array([number[x] for x in found["source"].to_pylist()], int), *(x.indices.to_numpy() for x in coded.values())]
            natural = [np.bincount(places[axis], tokens, len(x.dictionary)) / max(all_tokens, 1) for axis, x in enumerate(coded.values(), 1)]
            self.fit = rake_cells(tokens, places, [share, *natural], cap, total)
            wants = pa.table({"source": found["source"], "lang": found["lang"], "topic": found["topic"], "want": self.fit.copies, "cap": cap[places[0]]}).filter(pa.array(tokens > 0))
            cells = spark.createDataFrame(wants)
            cells = F.broadcast(cells) if wants.num_rows <= MOST_SENT else cells
        else:  # the same fit where the cells lie
            table, self.fit = rake_table(grouped, dict(zip(sources, share, strict=False)), dict(zip(sources, cap, strict=False)), total, scratch)
            cells = table.where("t > 0").select("source", "lang", "topic", F.col("copies").alias("want"), "cap")
        drawn = known.join(cells, ["source", "lang", "topic"])
        whole, u = F.floor("want"), (F.xxhash64("id").bitwiseAND((1 << 52) - 1)) / F.lit(float(1 << 52))
        part = F.col("want") - whole
        drawn = drawn.select("id", "source", "lang", "topic", "tokens", whole.cast("int").alias("whole"), "cap", F.when(part > 0, u / part).alias("ratio"))
        # the ratio up to which a source is drawn, 1 by expectation, moved to where the histogram meets the target
        steps = drawn.groupBy("source", F.least(F.ceil(F.col("ratio") * STEPS), F.lit(4 * STEPS)).alias("step")).agg(F.sum("tokens").alias("t"), F.sum(F.col("tokens") * F.col("whole")).alias("base")).collect()
        at = {s: i for i, s in enumerate(sources)}
        drawn_by, base = np.zeros((len(sources), 4 * STEPS + 1)), np.zeros(len(sources))
        for r in steps:
            base[at[r.source]] += r.base or 0
            if r.step is not None:
                drawn_by[at[r.source], r.step] += r.t
        # records beyond the last step are never drawn
        reached = np.cumsum(drawn_by[:, : 4 * STEPS], axis=1)
        limits = [(s, float(np.argmin(np.abs(reached[i] - (share[i] * total - base[i])))) / STEPS) for i, s in enumerate(sources)]
        limit = spark.createDataFrame(limits, "source string, upto double")
        chosen = drawn.join(F.broadcast(limit), "source")
        extra = F.when(F.col("ratio") <= F.col("upto"), 1).otherwise(0)
        placed = scratch.save(chosen.select("id", "source", "lang", "topic", "tokens", F.least(F.col("whole") + extra, F.col("cap").cast("int")).alias("copies")).where("copies > 0"))
        self.sample = placed.select("id", "source", "tokens", "copies")
        have = sized.groupBy("source").agg(F.sum("tokens").alias("tokens_available"), F.count("*").alias("documents"))
        took = self.sample.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("tokens_drawn"), F.max("copies").alias("most_copies"))
        drawn_all = float(took.agg(F.sum("tokens_drawn")).first()[0] or 0)
        wanted = spark.createDataFrame([(g.source, g.share, g.cap, float(share[i])) for i, g in enumerate(goals)], "source string, target_share double, max_repeats double, share_wanted double")
        report = have.join(wanted, "source", "full").join(took, "source", "left")
        zero = lambda c: F.coalesce(c, F.lit(0))
        self.report = report.select(
            "source", "target_share", "max_repeats", zero("documents").alias("documents"), zero("tokens_available").alias("tokens_available"), zero("tokens_drawn").alias("tokens_drawn"),
            zero("most_copies").alias("most_copies"), zero("share_wanted").alias("share_wanted"), (zero("tokens_drawn") / F.lit(max(drawn_all, 1.0))).alias("share_reached"),
        )
        each = lambda rows: rows.select("tokens", *([] if rows is known else ["copies"]), F.explode(F.array(*(F.struct(F.lit(a).alias("axis"), F.col(c).alias("value")) for a, c in (("language", "lang"), ("topic", "topic"))))).alias("x")).select("x.*", "*")
        there = each(known).groupBy("axis", "value").agg(F.sum("tokens").alias("tokens_available"))
        reached = each(placed).groupBy("axis", "value").agg(F.sum(F.col("tokens") * F.col("copies")).alias("tokens_drawn"))
        self.marginals = there.join(reached, ["axis", "value"], "left").select(
            "axis", F.nullif("value", F.lit("")).alias("value"), "tokens_available", zero("tokens_drawn").alias("tokens_drawn"),
            (F.col("tokens_available") / F.lit(max(all_tokens, 1.0))).alias("share_wanted"), (zero("tokens_drawn") / F.lit(max(drawn_all, 1.0))).alias("share_reached"),
        )
