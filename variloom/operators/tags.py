"""Synonymous tag windows in DNA sequences.

Sequences are cut into overlapping pieces first. A piece overlaps the next one by as much
as an operator looks ahead, so windows and their partners are found inside one row: a very
long sequence is worked on by many tasks, and windows, many times the size of their
sequence, are never shuffled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from variloom.functions import sequence as S
from variloom.operators.base import computed

WINDOW = S.WINDOW_CODONS
WINDOW_BASES = 3 * WINDOW
PIECE_CODONS = 2048
#: Sequence bytes for each partition of pieces.
PARTITION_BYTES = 4 << 20

#: Score and melting temperature of a codon or window share an integer: score * SHARE + temperature.
SHARE = 1000
#: What tells a piece; pieces are dealt by the first two.
_PIECE = ("seq_id", "first", "_row")
#: A partner is packed as score * FAR + (FAR - 1 - place), so the maximum is the nearest of the best.
FAR = 1 << 20

# Limits of the design parameters.
MIN_TEMP, MAX_TEMP = 0, 200
MIN_AMPLIFICATION, MAX_AMPLIFICATION = 100, 1000
MIN_PERCENT, MAX_PERCENT = 0, 100


@dataclass(frozen=True)
class TagParams:
    """Design parameters: temperature range, least percent changed, distance range in bases."""

    min_temp: float = MIN_TEMP
    max_temp: float = MAX_TEMP
    min_recoded: float = MIN_PERCENT
    min_distance: int = MIN_AMPLIFICATION
    max_distance: int = MAX_AMPLIFICATION

    @property
    def steps(self) -> tuple[int, int]:
        """Allowed difference, in codons, of the starts of two windows."""
        return (max(1, math.ceil(self.min_distance / 3) - WINDOW), self.max_distance // 3 - WINDOW)


def _pieces(seqs: DataFrame, need: int, overlap: int, spread: bool) -> DataFrame:
    """(seq_id, first codon, row, piece) rows; neighbours share ``overlap`` codons.

    ``_row`` keeps sequences of one id, or of none, apart inside a task.

    ``need`` is the number of codons the smallest result takes. Cutting works on bytes,
    where a position needs no scan from the start. ``spread`` shuffles the pieces into a
    number of partitions that follows the planner's size of the input, without a job: results are many
    times larger than pieces, so partitions must not be merged by the size of their input.
    """
    count = F.floor(F.length("_bytes") / 3) - (need - 1)
    numbers = F.when(count > 0, F.sequence(F.lit(0), F.ceil(count / PIECE_CODONS) - 1))
    cut = F.transform(F.coalesce(numbers, F.array().cast("array<bigint>")), lambda n: F.substring(
        F.col("_bytes"), (n * (3 * PIECE_CODONS) + 1).cast("int"), F.lit(3 * (PIECE_CODONS + overlap))))
    rows = seqs.select("seq_id", F.monotonically_increasing_id().alias("_row"), F.col("seq").cast("binary").alias("_bytes")).select(
        "seq_id", "_row", F.posexplode(cut).alias("_n", "piece"))
    out = rows.select("seq_id", (F.col("_n").cast("bigint") * PIECE_CODONS).alias("first"), "_row", "piece")
    if not spread:
        return out
    least = int(seqs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    planned = int(str(seqs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    # an input of unknown size counts as the largest number there is
    wanted = math.ceil(planned / PARTITION_BYTES) if planned < 1 << 60 else 0
    return out.repartition(max(least, wanted), "seq_id", "first")


def codon_table(seqs: DataFrame, organism: str = "human", spread: bool = True) -> DataFrame:
    """One row per codon: seq_id, i, codon, aa."""
    opened = _pieces(seqs, 1, 0, spread).select("seq_id", "first", F.posexplode(S.codons(F.col("piece").cast("string"))).alias("_k", "codon"))
    return opened.select("seq_id", (F.col("first") + F.col("_k")).alias("i"), "codon",
                         S.translate(F.col("codon"), organism).alias("aa"))


def _bases(source: str) -> Column:
    """The bases of window ``_k``."""
    return F.substring(source, F.col("_k") * 3 + 1, F.lit(WINDOW_BASES)).cast("string")


def codon_windows(seqs: DataFrame, spread: bool = True) -> DataFrame:
    """Every run of 8 codons: seq_id, start (codon index) and its bases ``old``."""
    last = F.floor(F.length("piece") / 3).cast("int") - WINDOW
    opened = _pieces(seqs, WINDOW, WINDOW - 1, spread).withColumn("_k", F.explode(F.sequence(F.lit(0), last)))
    return opened.select("seq_id", (F.col("first") + F.col("_k")).alias("start"), _bases("piece").alias("old"))


def _codon_rows(pieces: DataFrame, organism: str, full_serine: bool) -> DataFrame:
    """One row per codon of a piece: seq_id, first, ``_k``, codon, ``new`` and ``v``, its score and temperature.

    Codons are looked up once, in a table of 64 rows; another one keeps itself.
    """
    known = [(c, new, n * SHARE + sum(2 if b in "AT" else 4 for b in new)) for c, (new, n) in S.best_synonyms(organism, full_serine).items()]
    table = pieces.sparkSession.createDataFrame(known, "codon string, new string, v int")
    opened = pieces.select(*_PIECE, F.posexplode(S.codons(F.col("piece").cast("string"))).alias("_k", "codon"))
    return opened.join(F.broadcast(table), "codon", "left").select(
        *_PIECE, "_k", "codon", F.coalesce("new", "codon").alias("new"), F.coalesce("v", S.melting_temp(F.col("codon")).cast("int")).alias("v"))


def _whole() -> WindowSpec:
    return Window.partitionBy(*_PIECE)


def _along() -> WindowSpec:
    """The codons of a piece in order. Pieces are dealt by its columns, so their rows are sorted, not shuffled."""
    return _whole().orderBy("_k")


def _ahead(name: str) -> list[Column]:
    """The values of ``name`` at the codons of the window that starts here; NULL past the end."""
    return [F.col(name), *(F.lead(name, i).over(_along()) for i in range(1, WINDOW))]


def _summed(name: str) -> Column:
    """The sum of ``name``, never NULL, over the codons of the window that starts here; NULL past the end."""
    window = _along().rowsBetween(0, WINDOW - 1)
    return F.when(F.count(name).over(window) == WINDOW, F.sum(name).over(window).cast("int"))


def recode_windows(seqs: DataFrame, organism: str = "human", full_serine: bool = False) -> DataFrame:
    """Windows with every codon replaced by its most different synonym.

    Adds ``new``, ``score`` (changed bases), ``mt`` (melting temperature of ``new``) and
    ``pc`` (percent changed).
    """
    codons = _codon_rows(_pieces(seqs, WINDOW, WINDOW - 1, True), organism, full_serine)
    found = codons.select("seq_id", "first", "_k", F.concat(*_ahead("codon")).alias("old"), F.concat(*_ahead("new")).alias("new"),
                          _summed("v").alias("v")).where("old is not null")
    score = F.expr(f"cast(v div {SHARE} as int)")
    return found.select("seq_id", (F.col("first") + F.col("_k")).alias("start"), "old", "new", score.alias("score"),
                        (F.col("v") % SHARE).cast("double").alias("mt"), (score / WINDOW_BASES * 100).alias("pc"))


def _temp_ok(params: TagParams) -> Column:
    return F.col("mt").between(params.min_temp, params.max_temp)


def filter_windows(windows: DataFrame, params: TagParams) -> DataFrame:
    """Windows inside the temperature range with enough changed bases."""
    return windows.where(_temp_ok(params) & (F.col("pc") >= params.min_recoded))


def window_rejects(windows: DataFrame, params: TagParams) -> DataFrame:
    """Per sequence: windows kept and rejected, by the first reason that applies."""
    changed_ok = F.col("pc") >= params.min_recoded
    return windows.groupBy("seq_id").agg(
        F.count("*").alias("windows"),
        F.count_if(~_temp_ok(params)).alias("rejected_temp"),
        F.count_if(_temp_ok(params) & ~changed_ok).alias("rejected_percent"),
        F.count_if(_temp_ok(params) & changed_ok).alias("kept"))


def _scored(seqs: DataFrame, params: TagParams, organism: str, full_serine: bool) -> DataFrame:
    """One row per codon of the pieces, with ``s``, the score of the kept window that starts there or NULL.

    A piece holds every partner of its ``own`` windows, the first ``PIECE_CODONS``; the others are partners only.
    """
    low, high = params.steps
    if high < low:
        raise ValueError("no window pair fits the distance range")
    codons = _codon_rows(_pieces(seqs.where("seq_id is not null"), WINDOW, high + WINDOW - 1, True), organism, full_serine)
    summed = codons.select(*_PIECE, "_k", "new", _summed("v").alias("v"))
    kept = (f"v % {SHARE} between {params.min_temp} and {params.max_temp} "
            f"and v div {SHARE} / {WINDOW_BASES} * 100 >= {params.min_recoded}")
    return summed.select(*_PIECE, "_k", "new", F.expr(f"case when {kept} then cast(v div {SHARE} as int) end").alias("s"),
                         (F.col("_k") < PIECE_CODONS).alias("own"))


def _partnered(scored: DataFrame, low: int, high: int) -> DataFrame:
    """Adds to each window its nearest best partner, packed, as ``near``.

    Also ``upto``, the number of kept windows of the piece so far, and ``partners``: their number from
    ``low`` to ``high`` windows ahead, the difference of two such prefix sums.
    """
    reach = _along().rowsBetween(low, high)
    counted = scored.withColumns({"upto": F.count("s").over(_along().rowsBetween(Window.unboundedPreceding, 0)), "all": F.count("s").over(_whole())})
    ends = [F.coalesce(F.lead("upto", at).over(_along()), F.col("all")) for at in (high, low - 1)]
    packed = F.col("s") * F.lit(FAR).cast("bigint")
    return counted.withColumns({
        "partners": F.when(F.col("s").isNotNull(), ends[0] - ends[1]),
        "near": F.max(packed + (FAR - 1) - F.col("_k")).over(reach)})


#: The highest sum of an own window and one of its partners.
_REACHED_SQL = f"if(own and partners > 0, s + cast(near div {FAR} as int), null)"


def window_partners(seqs: DataFrame, params: TagParams, organism: str = "human", full_serine: bool = False) -> DataFrame:
    """One row per kept window that has partners: how many, the best summed score and the nearest best partner.

    Columns: seq_id, left_start, partners, score, right_start. Pairs are not listed, so the result is
    as long as the sequences whatever the distance range.
    """
    found = _partnered(_scored(seqs, params, organism, full_serine), *params.steps).where("own and partners > 0")
    return found.select("seq_id", (F.col("first") + F.col("_k")).alias("left_start"), F.col("partners").cast("int").alias("partners"),
                        F.expr(f"cast(s + near div {FAR} as int)").alias("score"), (F.col("first") + F.expr(f"{FAR - 1} - near % {FAR}")).alias("right_start"))


def _records(rows: DataFrame, *more: str) -> DataFrame:
    """One row per piece: arrays by codon of ``s`` (-1 for none), ``more`` columns, and the recoded bases ``new``."""
    each = F.struct("_k", F.coalesce("s", F.lit(-1)).cast("byte").alias("s"), "new", *(F.coalesce(c, F.lit(-1)).alias(c) for c in more))
    listed = rows.groupBy(*_PIECE).agg(F.sort_array(F.collect_list(each)).alias("a"))
    return computed(listed, "seq_id", "first", s=F.col("a.s"), new=F.array_join("a.new", ""), **{c: F.col(f"a.{c}") for c in more})


def window_pairs(seqs: DataFrame, params: TagParams, organism: str = "human", full_serine: bool = False) -> DataFrame:
    """Pairs of kept windows whose distance (start of the left to end of the right) is in range.

    A window's partners lie a bounded way ahead in the same piece: no join, no window shuffle.
    """
    low, high = params.steps
    lefts = _records(_scored(seqs, params, organism, full_serine)).withColumn(
        "_k", F.explode(F.expr(f"filter(sequence(0, least(size(s), {PIECE_CODONS}) - 1), k -> s[k] >= 0)")))
    return _pairs(lefts, F.expr(f"filter(sequence(_k + {low}, _k + {high}), j -> get(s, j) >= 0)"), (F.expr("s[_k] + s[_j]").cast("int")).alias("score"))


def _pairs(opened: DataFrame, partners: Column, *columns: Column | str) -> DataFrame:
    """Pairs of window ``_k`` with each of ``partners``, both numbers within the piece."""
    step = F.col("_j") - F.col("_k")
    return opened.withColumn("_j", F.explode(partners)).select(
        "seq_id", (F.col("first") + F.col("_k")).alias("left_start"), (F.col("first") + F.col("_j")).alias("right_start"),
        ((step + WINDOW) * 3).alias("distance"), *columns)


def _with_bytes(records: DataFrame) -> DataFrame:
    """Adds ``_bytes``, the recoded bases where each letter is one byte: a window is found there without reading the letters before it."""
    return computed(records, _bytes=F.when(F.octet_length("new") == F.length("new"), F.col("new").cast("binary")))


def _pair_details() -> list[Column]:
    def bases(at: str) -> Column:
        return F.expr(f"coalesce(cast(substring(_bytes, {at} * 3 + 1, {WINDOW_BASES}) as string), substring(new, {at} * 3 + 1, {WINDOW_BASES}))")

    return [F.expr("cast(s[_k] as int)").alias("left_score"), F.expr("cast(s[_j] as int)").alias("right_score"),
            F.expr("cast(s[_k] + s[_j] as int)").alias("score"), bases("_k").alias("left_new"), bases("_j").alias("right_new")]


def _top_records(seqs: DataFrame, params: TagParams, organism: str, full_serine: bool) -> DataFrame:
    """Records of the pieces that reach their sequence's highest sum ``_top``, with the windows ``_lefts`` that do.

    Each piece is scored once: a sequence's highest sum is found among its pieces after their only exchange. ``_lefts`` is never empty.
    """
    rows = _partnered(_scored(seqs, params, organism, full_serine), *params.steps).withColumn("r", F.expr(_REACHED_SQL))
    pieces = computed(_records(rows, "r"), "seq_id", "first", "s", "new", "r", _top=F.array_max("r")).where("_top >= 0")
    best = pieces.withColumn("_best", F.max("_top").over(Window.partitionBy("seq_id"))).where("_top = _best").drop("_best")
    return _with_bytes(best).withColumn("_lefts", F.expr("filter(sequence(0, size(r) - 1), k -> r[k] = _top)"))


def _recoded_bases(old: Column, organism: str, full_serine: bool) -> Column:
    """A few bases with every codon replaced."""
    return F.array_join(F.transform(S.codons(old), lambda c: F.coalesce(S.best_synonym(c, organism, full_serine), c)), "")


def pair_ties(seqs: DataFrame, params: TagParams, organism: str = "human", full_serine: bool = False) -> DataFrame:
    """Per sequence, the pairs of kept windows in distance range with the highest summed score, without listing them.

    ``score``, ``ties`` (their number), ``min_distance``, the first and the last of them by left, then right
    window (``first_left``, ``first_right``, ``left_start``, ``right_start``) and the last one's details.
    The partners of one window that reach the score have one score themselves, so their number is the
    difference of the numbers of equal windows along the piece, up to the last and up to the first of them.
    """
    low, high = params.steps
    rows = _scored(seqs, params, organism, full_serine).withColumn(
        "like", F.row_number().over(Window.partitionBy(*_PIECE, "s").orderBy("_k")).cast("bigint"))
    reach = _along().rowsBetween(low, high)

    def packed(place: Column) -> Column:
        return (F.col("s") * F.lit(FAR).cast("bigint") + place) * FAR + F.col("like")

    rows = rows.withColumns({"near": F.max(packed(FAR - 1 - F.col("_k"))).over(reach), "far": F.max(packed(F.col("_k"))).over(reach)})
    rows = rows.where("own and s is not null and near is not null").withColumn("r", F.expr(f"s + cast(near div {FAR * FAR} as int)"))
    # most windows fall here, before the only shuffle after the pieces'
    reached = rows.withColumn("most", F.max("r").over(_whole())).where("r = most").select(
        "seq_id", "r", "s", (F.col("first") + F.col("_k")).alias("left_start"),
        *((F.col("first") + F.expr(e)).alias(n) for n, e in (("near_start", f"{FAR - 1} - near div {FAR} % {FAR}"), ("right_start", f"far div {FAR} % {FAR}"))),
        F.expr(f"far % {FAR} - near % {FAR} + 1").alias("n"))
    sums = reached.groupBy("seq_id", "r").agg(
        F.sum("n").alias("ties"), F.min(F.col("near_start") - F.col("left_start")).alias("closest"),
        F.min(F.struct(F.col("left_start").alias("first_left"), F.col("near_start").alias("first_right"))).alias("_f"),
        F.max(F.struct("left_start", "right_start", "s")).alias("_l"))
    top = sums.groupBy("seq_id").agg(F.max(F.struct("r", "ties", "closest", "_f", "_l")).alias("_t")).select("seq_id", "_t.*")
    bases = seqs.where("seq_id is not null").join(top, "seq_id")
    new = {f"{side}_new": _recoded_bases(F.substring("seq", (F.col(f"_l.{side}_start") * 3 + 1).cast("int"), F.lit(WINDOW_BASES)), organism, full_serine)
           for side in ("left", "right")}
    return bases.select(
        "seq_id", "ties", ((F.col("closest") + WINDOW) * 3).alias("min_distance"), "_f.*", "_l.left_start", "_l.right_start",
        ((F.col("_l.right_start") - F.col("_l.left_start") + WINDOW) * 3).alias("distance"), F.col("_l.s").alias("left_score"),
        (F.col("r") - F.col("_l.s")).alias("right_score"), F.col("r").alias("score"), *(c.alias(n) for n, c in new.items()))


def parity_tail(seqs: DataFrame, params: TagParams, organism: str = "human", full_serine: bool = False) -> DataFrame:
    """What the search gives that never raises its score to beat: per sequence with pairs, counted, not listed.

    Every pair with a positive sum replaces the result so far, and one with sum 0 joins it. So the result is the
    last positive pair (``left_start``, ``right_start``; NULL without one) and the pairs after it, all of sum 0:
    ``tail`` is their number. ``last_left`` and ``last_right`` are the last pair of all.
    """
    low, high = params.steps
    rows = _partnered(_scored(seqs, params, organism, full_serine), low, high)
    reach = _along().rowsBetween(low, high)
    # the last partner, and the last with a score, each packed with the number of kept windows up to it
    mark = F.col("_k").cast("bigint") * FAR + F.col("upto")
    rows = rows.withColumns({"any_far": F.max(F.when(F.col("s").isNotNull(), mark)).over(reach), "pos_far": F.max(F.when(F.col("s") > 0, mark)).over(reach)})
    rows = rows.where("own and partners > 0").withColumn("to", F.expr("if(s > 0, any_far, pos_far)"))
    rows = rows.withColumn("last", F.max(F.when(F.col("to").isNotNull(), F.col("_k"))).over(_whole()))
    after = F.expr(f"case when last is null or _k > last then partners when _k = last then any_far % {FAR} - to % {FAR} else 0 end")
    at = {n: (F.col("first") + F.expr(e)) for n, e in (("left", "_k"), ("right", f"to div {FAR}"), ("end", f"any_far div {FAR}"))}
    piece = rows.groupBy(*_PIECE).agg(
        F.sum("partners").alias("pairs"), F.sum(after).alias("after"),
        F.max(F.when(F.col("to").isNotNull(), F.struct(at["left"].alias("left_start"), at["right"].alias("right_start")))).alias("p"),
        F.max(F.struct(at["left"].alias("last_left"), at["end"].alias("last_right"))).alias("e"))
    # the sequence's last pairs, among its pieces: those are scored once
    whole = Window.partitionBy("seq_id")
    rest = piece.select("seq_id", "first", "pairs", "after", F.max("p").over(whole).alias("p"), F.max("e").over(whole).alias("e"),
                        F.max(F.when(F.col("p").isNotNull(), F.col("first"))).over(whole).alias("upto"))
    # pieces after the last positive pair's count in full, its own from there on
    rest = rest.where("upto is null or first >= upto")
    return rest.groupBy("seq_id").agg(F.first("p").alias("p"), F.first("e").alias("e"), F.sum(F.expr("if(first = upto, after, pairs)")).alias("tail")).select(
        "seq_id", "p.*", "tail", "e.*")


def best_pairs(seqs: DataFrame, params: TagParams, mode: str = "intended", organism: str = "human",
               full_serine: bool = False) -> DataFrame:
    """Pairs of kept windows in distance range with the highest summed score of their sequence.

    ``intended`` gives every tie; :func:`pair_ties` counts them. ``parity`` gives the last pair with a positive score,
    by left, then right window; :func:`parity_tail` counts what follows it.
    """
    low, high = params.steps
    if mode == "intended":
        lefts = _top_records(seqs, params, organism, full_serine).withColumn("_k", F.explode_outer("_lefts"))
        return _pairs(lefts, F.expr(f"filter(sequence(_k + {low}, _k + {high}), j -> get(s, j) = _top - s[_k])"), *_pair_details())
    if mode != "parity":
        raise ValueError("mode must be 'intended' or 'parity'")
    rows = _scored(seqs, params, organism, full_serine)
    reach = _along().rowsBetween(low, high)
    to = F.when(F.col("s") > 0, F.max(F.when(F.col("s").isNotNull(), F.col("_k"))).over(reach)).when(F.col("s") == 0, F.max(F.when(F.col("s") > 0, F.col("_k"))).over(reach))
    rows = rows.withColumn("to", F.when(F.col("own"), to))
    last = _with_bytes(_records(rows, "to")).withColumn("_k", F.expr("array_max(filter(sequence(0, size(to) - 1), k -> to[k] >= 0))")).where("_k is not null")
    return last_pair(_pairs(last, F.array(F.expr("to[_k]")), *_pair_details()))


def design_tags(seqs: DataFrame, params: TagParams = TagParams(), mode: str = "intended") -> DataFrame:
    """Best tag pairs of each sequence: clean, recode, filter, pair."""
    cleaned = seqs.select("seq_id", S.clean_sequence(F.col("seq")).alias("seq"))
    return best_pairs(cleaned, params, mode)


def last_pair(pairs: DataFrame) -> DataFrame:
    """The last of a sequence's tied pairs, by left, then right window."""
    rest = [c for c in pairs.columns if c not in ("seq_id", "left_start", "right_start")]
    last = F.max(F.struct("left_start", "right_start", *rest)).alias("_p")
    return pairs.groupBy("seq_id").agg(last).select("seq_id", "_p.*")


def apply_tags(seqs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Sequences with both windows of a pair replaced by their new bases."""
    joined = seqs.join(pairs, "seq_id")
    left, right = F.col("left_start") * 3, F.col("right_start") * 3
    tagged = F.overlay(F.overlay("seq", "left_new", (left + 1).cast("int")), "right_new", (right + 1).cast("int"))
    return joined.withColumn("tagged", tagged)


def validate_sequences(seqs: DataFrame, min_amplification: int = MIN_AMPLIFICATION,
                       mode: str = "intended") -> DataFrame:
    """Add ``errors``: other letters than A, C, G, T; fewer bases than the least amplification.

    ``parity`` counts white space into the length.
    """
    bare = F.regexp_replace("seq", r"\s+", "")
    length = F.length(bare if mode == "intended" else F.col("seq"))
    return seqs.withColumn("errors", F.array_compact(F.array(
        F.when(~bare.rlike("^[ACGTacgt]*$"), "alphabet"),
        F.when(length < min_amplification, "length"))))


def validate_design(params: DataFrame) -> DataFrame:
    """Add ``errors`` to rows of design parameters given as text or numbers."""
    def number(name: str) -> Column:
        return F.col(name).cast("string").try_cast("double")

    def outside(name: str, low: float, high: float) -> Column:
        return F.when(~F.coalesce(number(name).between(low, high), F.lit(False)), name)

    return params.withColumn("errors", F.array_compact(F.array(
        outside("min_temp", MIN_TEMP, MAX_TEMP), outside("max_temp", MIN_TEMP, MAX_TEMP),
        F.when(number("min_temp") > number("max_temp"), "temp_range"),
        outside("min_recoded", MIN_PERCENT, MAX_PERCENT),
        outside("min_amp", MIN_AMPLIFICATION, MAX_AMPLIFICATION),
        outside("max_amp", MIN_AMPLIFICATION, MAX_AMPLIFICATION),
        F.when(number("min_amp") > number("max_amp"), "amp_range"))))
