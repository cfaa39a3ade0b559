"""Periodic runs of words by a dictionary of basic factors, one pass of Arrow batches and no shuffle.

A run is a stretch of words with smallest period q (words q apart are the same) and a length of at least `LEAST` words and
`TIMES` periods that neither neighbour extends. The dictionary names the factors of 16, 32, 64, ... words; a name's next
occurrence at a distance up to the factor's length proposes that distance as a period. Successive places with the same
distance form one progression: it begins where the run does and ends one factor and one period before the run's end,
because a factor no shorter than the period recurs in a run after exactly one period. So each run is one progression of
one level (the shortest factor not below its period), whole as it stands, and found once.

Null and empty texts have no runs and collapse to an empty text. Repeated rows give repeated rows, other columns than
doc_id and text are not read. A document is worked on as a whole, with memory in proportion to its own words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import forget, mix64, text_rounds

LEAST, TIMES = 24, 3
#: The first level asked for successors, 2 ** 4 words: a run of 24 words shows a factor of 16 twice at any period up to 8.
FIRST = 4
RUN = "struct<start:bigint,length:bigint,period:bigint>"
RESULT = f"doc_id bigint, runs array<{RUN}>, strongest {RUN}, collapsed string"
SPACES = r"[ \t\n\x0B\f\r]+"


def words_of(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words between ASCII white space, and the place where each text's words end."""
    lists = pc.ascii_split_whitespace(pc.fill_null(column, ""))
    ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
    flat = lists.flatten()
    kept = pc.greater(pc.binary_length(flat), 0)
    count = np.concatenate([[0], np.cumsum(kept.to_numpy(zero_copy_only=False))])
    return flat.filter(kept), count[ends]


def _first_names(ids: np.ndarray, doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Names of the factors of 2 ** FIRST words at some places, equal for equal factors of one document. They are hashes
    of pairs of shorter names; where two different factors have one hash, names are taken from the words themselves."""
    size = 1 << FIRST
    with np.errstate(over="ignore"):
        names = mix64(mix64(doc) + ids.astype(np.uint64))
        for k in range(FIRST):
            half = 1 << k
            names = mix64(names[:-half] * np.uint64(0x9E3779B97F4A7C15) + names[half:])
    found = names[at]
    order, follows = _ordered(found)
    one, two = at[order[:-1][follows]], at[order[1:][follows]]
    if all((ids[one + k] == ids[two + k]).all() and (doc[one] == doc[two]).all() for k in range(size)):
        return found
    rows = np.column_stack([doc[at], *(ids[at + k] for k in range(size))])
    return np.unique(rows, axis=0, return_inverse=True)[1].reshape(-1).astype(np.uint64)


def _ordered(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by name and then place, and where the next in that order has the same name."""
    order = np.argsort(names, kind="stable")
    ranked = names[order]
    return order, ranked[1:] == ranked[:-1]


def find_runs(ids: np.ndarray, ends: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """Rows (document, start, length, period), by document, start and period, of numbered words of several documents."""
    if (1 << FIRST) > least - least // times or times < 3:
        raise ValueError("runs must have at least three periods, and the first level two factors in the shortest run")
    sizes = np.diff(ends, prepend=0)
    begins = ends - sizes
    doc = np.repeat(np.arange(len(ends)), sizes)
    room = ends[doc] - np.arange(len(ids))
    length = 1 << FIRST
    at = np.flatnonzero(room >= length)
    if not len(at):
        return np.zeros((0, 4), np.int64)
    names, found, first = _first_names(ids, doc, at), [], True
    while True:
        order, follows = _ordered(names)
        if not follows.any():
            break
        here, distance = at[order[:-1][follows]], (at[order[1:]] - at[order[:-1]])[follows]
        band = (distance <= length) & (first | (distance > length // 2))
        place, period = here[band], distance[band]
        if len(place):
            by = np.argsort(place)
            place, period = place[by], period[by]
            cut = np.concatenate([[True], (np.diff(place) != 1) | (np.diff(period) != 0), [True]])
            head, tail = np.flatnonzero(cut[:-1]), np.flatnonzero(cut[1:])
            start, q = place[head], period[head]
            whole = place[tail] - start + length + q
            long = whole >= np.maximum(least, times * q)
            found.append(np.column_stack([doc[start[long]], start[long] - begins[doc[start[long]]], whole[long], q[long]]))
        # The next level needs both halves named here; a factor that doesn't recur can't be half of one that does.
        group = np.cumsum(np.concatenate([[True], ~follows]))
        recurs = np.zeros(len(order), bool)
        recurs[order[1:][follows]] = recurs[order[:-1][follows]] = True
        rank = np.full(len(ids), -1, np.int64)
        rank[at[order]] = np.where(recurs[order], group, -1)
        at = at[recurs]
        at = at[room[at] >= 2 * length]
        at = at[rank[at + length] >= 0]
        names = rank[at] * (len(order) + 1) + rank[at + length]
        length, first = 2 * length, False
    rows = np.concatenate(found) if found else np.zeros((0, 4), np.int64)
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def stronger(one: tuple, two: tuple) -> bool:
    """Whether the first (start, length, period) has the greater exact length / period, or comes first of equals."""
    a, b = one[1] * two[2], two[1] * one[2]
    return a > b or a == b and (one[0], one[2]) < (two[0], two[2])


def _rows(doc_ids: pa.Array, column: pa.Array, least: int, times: int) -> pa.RecordBatch:
    words, ends = words_of(column)
    ids = words.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    found = find_runs(ids, ends, least, times)
    begins = np.concatenate([[0], ends[:-1]])
    dropped = np.zeros(len(ids) + 1, np.int32)
    np.add.at(dropped, begins[found[:, 0]] + found[:, 1] + found[:, 3], 1)
    np.add.at(dropped, begins[found[:, 0]] + found[:, 1] + found[:, 2], -1)
    kept = np.flatnonzero(np.cumsum(dropped)[:-1] == 0)
    texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.searchsorted(kept, ends)]), pa.int32()), words.take(pa.array(kept))), " ")
    runs: list[list[dict]] = [[] for _ in range(len(column))]
    best: list[tuple | None] = [None] * len(column)
    for d, *run in found.tolist():
        runs[d].append(dict(zip(("start", "length", "period"), run, strict=True)))
        if best[d] is None or stronger(tuple(run), best[d]):
            best[d] = tuple(run)
    kind = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])
    strongest = [b and dict(zip(("start", "length", "period"), b, strict=True)) for b in best]
    return pa.RecordBatch.from_arrays([doc_ids, pa.array(runs, pa.list_(kind)), pa.array(strongest, kind), texts], ["doc_id", "runs", "strongest", "collapsed"])


def periodic_runs(documents: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """doc_id, runs (by start, then period), the strongest run (null without runs) and the text with each run's words
    after its first period left out, words joined by one space; one row for each row of documents."""

    def run(batches):
        forget()
        for batch in batches:
            for at, texts in text_rounds(batch.column(1)):
                yield _rows(batch.column(0).slice(at, len(texts)), texts, least, times)

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, RESULT)


def with_repeats(text: Column, doc_id: Column) -> Column:
    """The text in which, for a tenth of the ids, words from a place on repeat those of the first period there."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")
    n = F.size(words)
    a = (g % F.greatest(n, F.lit(1))).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    cycle = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    made = F.array_join(F.concat(F.slice(words, F.lit(1), a), F.slice(cycle, F.lit(1), n - a)), " ")
    return F.when((h % 10 == 0) & (n > 0), made).otherwise(text)


def run_digest(documents: DataFrame) -> DataFrame:
    """Digests of the runs and collapsed texts of `with_repeats`."""
    made = documents.select(F.col("doc_id").cast("long").alias("doc_id"), with_repeats(F.col("text"), F.col("doc_id").cast("long")).alias("text"))
    found = periodic_runs(made)
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    best = F.col("strongest")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"), F.expr("(1000 * strongest.length) div strongest.period").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
