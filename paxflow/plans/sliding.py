"""Statistics over sliding frames, in Arrow batches.

Spark's own sliding window recomputes every frame from its first row, so a frame of 365 rows, or of
40,000 minutes, costs that much for each row, and an exact median costs a sort on top. Here Spark
partitions and sorts the rows, and each task moves the frame along its sorted rows, adding and
removing one value at a time.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pandas.api.indexers import BaseIndexer
from pyspark.sql import DataFrame

VALUE = "_value"
STATS = "_stats"
WEIGHT = "_weight"
# Sentinel that a combined (segment, time) key must stay under.
_KEY_LIMIT = 2**62


class _Frames(BaseIndexer):
    """Frames given as first row and one past the last row."""

    def get_window_bounds(self, num_values=0, min_periods=None, center=None, closed=None, step=None):
        return self.first, self.stop


def _merged(one: tuple, two: tuple) -> tuple:
    """Counts, means, squared deviations and sums of two disjoint sets of rows taken together."""
    (n1, m1, s1, t1), (n2, m2, s2, t2) = one, two
    n = n1 + n2
    share = n2 / np.where(n > 0, n, 1.0)
    gap = m2 - m1
    return n, m1 + gap * share, s1 + s2 + gap * gap * n1 * share, t1 + t2


def _spread(values: np.ndarray, weights: np.ndarray, first: np.ndarray, stop: np.ndarray) -> tuple:
    """Count, squared deviations and sum of each frame, from the rows in it alone.

    Rows are merged in pairs, pairs in fours, and so on; a frame is put together from the few nodes
    that cover it, so what lies outside, however large, leaves no rounding error behind.
    """
    level = (weights, values, np.zeros(len(values)), weights * values)
    left, right = first.copy(), np.maximum(stop, first)
    low = high = (np.zeros(len(first)),) * 4
    while (left < right).any():
        level = tuple(np.append(x, 0.0) for x in level)  # a node of no rows to point at
        none = len(level[0]) - 1
        open_ = left < right
        odd = open_ & (left % 2 == 1)
        low = _merged(low, tuple(x[np.where(odd, left, none)] for x in level))
        left = left + odd
        odd = open_ & (right % 2 == 1) & (left < right)
        high = _merged(tuple(x[np.where(odd, right - 1, none)] for x in level), high)
        right = right - odd
        left, right = left // 2, right // 2
        even = none + none % 2
        level = tuple(x[:even] for x in level)
        level = _merged(tuple(x[::2] for x in level), tuple(x[1::2] for x in level))
    count, _, squares, total = _merged(low, high)
    return count, squares, total


def _moments(values: pd.Series, first: np.ndarray, stop: np.ndarray, stats) -> dict:
    frames = values.rolling(_Frames(first=first, stop=stop), min_periods=1)
    out = {s: getattr(frames, s)().to_numpy() for s in stats if s not in ("mean", "std")}
    known = values.notna().to_numpy()
    out |= _mean_and_std(values.fillna(0.0).to_numpy(), known.astype("float64"), first, stop, stats)
    return {stat: out[stat] for stat in stats}


def _mean_and_std(values, weights, first, stop, stats) -> dict:
    if not {"mean", "std"} & set(stats):
        return {}
    count, squares, total = _spread(values, weights, first, stop)
    with np.errstate(divide="ignore", invalid="ignore"):
        deviation = np.sqrt(np.where(count > 1, squares / (count - 1), np.nan))
        mean = np.where(count > 0, total / count, np.nan)
    return {"mean": mean, "std": deviation}


def _ranked(order: np.ndarray, weights: np.ndarray, first, stop, rank) -> np.ndarray:
    """Order number of the value at a weighted rank of each frame.

    ``order`` numbers the distinct values upwards. Bit by bit, from the highest, each frame goes on
    with its rows whose bit is 0 or 1, whichever holds the rank; the rows are regrouped by that bit
    for all frames at once.
    """
    found = np.zeros(len(first), dtype="int64")
    for bit in reversed(range(max(1, int(order.max(initial=0)).bit_length()))):
        one = (order >> bit & 1).astype(bool)
        zeros = np.concatenate([[0], np.cumsum(~one)])
        weight = np.concatenate([[0.0], np.cumsum(np.where(one, 0.0, weights))])
        below = weight[stop] - weight[first]
        up = rank >= below
        rank = np.where(up, rank - below, rank)
        first = np.where(up, zeros[-1] + first - zeros[first], zeros[first])
        stop = np.where(up, zeros[-1] + stop - zeros[stop], zeros[stop])
        found = found * 2 + up
        regrouped = np.concatenate([np.flatnonzero(~one), np.flatnonzero(one)])
        order, weights = order[regrouped], weights[regrouped]
    return found


def _weighted_moments(
    values: pd.Series, weights: np.ndarray, first: np.ndarray, stop: np.ndarray, stats
) -> dict:
    """As ``_moments`` where a row stands for ``weights`` equal rows; missing values do not count."""
    weights = np.where(values.isna(), 0.0, weights)
    known = values.fillna(0.0).to_numpy()
    total = np.concatenate([[0.0], np.cumsum(weights)])
    count = total[stop] - total[first]
    some = count > 0
    out = _moments(values, first, stop, ("min", "max"))
    out |= _mean_and_std(known, weights, first, stop, stats)
    if "median" in stats:
        distinct, order = np.unique(known, return_inverse=True)
        middle = [np.floor((count - 1) / 2), np.floor(count / 2)]
        # An empty frame holds no rank and ends past the last value; it is set aside below.
        places = [_ranked(order, weights, first, stop, m) for m in middle]
        low, high = (distinct[np.minimum(p, len(distinct) - 1)] for p in places)
        out["median"] = np.where(some, (low + high) / 2, np.nan)
    return {stat: out[stat] for stat in stats}


def _segment_starts(pdf: pd.DataFrame, keys: list[str]) -> np.ndarray:
    """True where a row opens a new run of equal keys (missing keys equal each other)."""
    opens = np.zeros(len(pdf), dtype=bool)
    opens[:1] = True
    for key in keys:
        here = pdf[key].to_numpy(dtype=object)
        opens[1:] |= here[1:] != here[:-1]
    return opens


def _schema(df: DataFrame, keep: list[str]) -> str:
    kept = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep]
    return ", ".join([*kept, f"{STATS} array<double>"])


def _batches(kept: pa.Table, stats: np.ndarray) -> list[pa.RecordBatch]:
    """Kept columns as they came, and one list of statistics per row; NaN becomes null."""
    width = stats.shape[1]
    offsets = pa.array(np.arange(0, stats.size + 1, width, dtype="int32"))
    lists = pa.ListArray.from_arrays(offsets, pa.array(stats.ravel(), from_pandas=True))
    return kept.append_column(STATS, lists).combine_chunks().to_batches()


def row_frames(
    df: DataFrame, keys: list[str], keep: list[str], windows: dict[str, int], gap: int, stats
) -> DataFrame:
    """Frames of n rows ending ``gap`` rows before the current one, for rows sorted by key.

    Adds ``_stats``: the statistics of the first window, then of the second, and so on. A task
    holds one batch and the rows the longest frame reaches back, never a whole group.
    """
    reach = max(windows.values()) + gap - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        context = None
        for batch in batches:
            given = pa.Table.from_batches([batch])
            fresh = given.select([*keys, VALUE])
            table = fresh if context is None else pa.concat_tables([context, fresh])
            rows = table.to_pandas()
            index = np.arange(len(rows))
            opening = np.maximum.accumulate(np.where(_segment_starts(rows, keys), index, 0))
            values = rows[VALUE].astype("float64")
            columns = []
            for size in windows.values():
                first = np.maximum(index - (size + gap - 1), opening)
                stop = np.maximum(index - gap + 1, first)
                columns += _moments(values, first, stop, stats).values()
            held = table.num_rows - given.num_rows
            yield from _batches(given.select(keep), np.column_stack(columns)[held:])
            context = table.slice(max(0, table.num_rows - reach))

    return df.mapInArrow(run, _schema(df, keep))


def time_frames(
    df: DataFrame,
    keys: list[str],
    clock: str,
    keep: list[str],
    windows: list[tuple[int, int]],
    side: str,
    stats,
    weighted: bool = False,
) -> DataFrame:
    """Frames over a whole-number clock, for rows sorted by (keys, clock); adds ``_stats``.

    A window (a, b) covers clock values from t+a to t+b. ``side='right'`` means (t+a, t+b],
    ``side='left'`` means [t+a, t+b). A task holds one run of equal keys at a time, so the keys
    must include a time slice. With ``weighted`` a row stands for ``_weight`` equal rows, and one
    row comes out per key and clock value.
    """
    margin = 2 * max(abs(edge) for pair in windows for edge in pair) + 2
    needed = list(dict.fromkeys([*keys, clock, VALUE, *([WEIGHT] if weighted else [])]))

    def compute(kept: pa.Table, rows: pd.DataFrame, line: np.ndarray) -> list[pa.RecordBatch]:
        values = rows[VALUE].astype("float64")
        columns = []
        for low, high in windows:
            first = np.searchsorted(line, line + low, side=side)
            stop = np.maximum(np.searchsorted(line, line + high, side=side), first)
            if weighted:
                weights = rows[WEIGHT].to_numpy(dtype="float64")
                columns += _weighted_moments(values, weights, first, stop, stats).values()
            else:
                columns += _moments(values, first, stop, stats).values()
        result = np.column_stack(columns)
        if weighted:
            once = np.diff(line, prepend=-1) != 0
            kept, result = kept.filter(pa.array(once)), result[once]
        return _batches(kept, result)

    return df.mapInArrow(_segments(keys, clock, needed, keep, margin, compute), _schema(df, keep))


def time_history(
    df: DataFrame,
    keys: list[str],
    clock: str,
    keep: list[str],
    owned: str,
    lags: list[str],
    windows: list[tuple[int, int, int]],
    stats,
    reach: int,
) -> DataFrame:
    """What reaches a row from rows before, for rows sorted by (keys, clock), the clock unique in a key.

    ``lags`` are columns that say when a row's value arrives; of rows that arrive together the latest
    counts. A window (delay, a, b) is looked up at t-delay, if there is a row, and covers (t-delay+a,
    t-delay+b]. ``_stats`` holds a value a lag and the statistics of each window, for the rows with
    ``owned`` that anything reaches. No row arrives more than ``reach`` later.
    """
    edges = [abs(edge) for _, *pair in windows for edge in pair]
    margin = 2 * max([reach, *edges]) + 2
    needed = list(dict.fromkeys([*keys, clock, VALUE, owned, *lags]))
    width = len(lags) + len(windows) * len(stats)

    def compute(kept: pa.Table, rows: pd.DataFrame, line: np.ndarray) -> list[pa.RecordBatch]:
        asks = rows[owned].to_numpy(dtype=bool)
        at = line[asks]
        values = rows[VALUE].astype("float64")
        found, met = np.full((len(at), width), np.nan), np.zeros(len(at), dtype=bool)
        for i, name in enumerate(lags):
            arrives = line + rows[name].to_numpy(dtype="int64") - rows[clock].to_numpy(dtype="int64")
            order = np.argsort(arrives, kind="stable")
            place = np.searchsorted(arrives[order], at, side="right") - 1
            source = order[np.maximum(place, 0)]
            hit = (place >= 0) & (arrives[source] == at)
            found[hit, i] = values.to_numpy()[source[hit]]
            met |= hit
        for i, (delay, low, high) in enumerate(windows):
            source = np.minimum(np.searchsorted(line, at - delay), len(line) - 1)
            hit = line[source] == at - delay
            if not hit.any():
                continue
            first = np.searchsorted(line, line + low, side="right")
            stop = np.maximum(np.searchsorted(line, line + high, side="right"), first)
            columns = np.column_stack([*_moments(values, first, stop, stats).values()])
            start = len(lags) + i * len(stats)
            found[hit, start : start + len(stats)] = columns[source[hit]]
            met |= hit
        return _batches(kept.filter(pa.array(asks)).filter(pa.array(met)), found[met])

    return df.mapInArrow(_segments(keys, clock, needed, keep, margin, compute), _schema(df, keep))


def _segments(keys: list[str], clock: str, needed: list[str], keep: list[str], margin: int, compute):
    """A task over rows sorted by (keys, clock) that hands whole runs of equal keys to ``compute``: the kept
    columns, the needed ones, and the clock with the runs laid end to end, ``margin`` apart."""

    def whole_segments(parts: list[pa.Table]) -> Iterable[pa.RecordBatch]:
        table = pa.concat_tables(parts)
        if not table.num_rows:
            return
        rows = table.select(needed).to_pandas()
        opens = _segment_starts(rows, keys)
        starts = np.append(np.flatnonzero(opens), len(rows))
        time = rows[clock].to_numpy(dtype="int64")
        longest = int((time[starts[1:] - 1] - time[starts[:-1]]).max())
        fit = max(1, _KEY_LIMIT // (longest + margin))
        for at in range(0, len(starts) - 1, fit):
            low, high = int(starts[at]), int(starts[min(at + fit, len(starts) - 1)])
            # Segments are laid end to end on one clock, far enough apart that no frame spans two.
            segment = np.cumsum(opens[low:high]) - 1
            elapsed = time[low:high] - time[low:high][opens[low:high]][segment]
            yield from compute(
                table.slice(low, high - low).select(keep),
                rows.iloc[low:high].reset_index(drop=True),
                segment * (int(elapsed.max()) + margin) + elapsed,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        parts: list[pa.Table] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            # Everything before the batch's last opening is complete; the rest may go on in the
            # next batch. A batch that only goes on with the open segment completes nothing.
            last = int(np.flatnonzero(_segment_starts(table.select(keys).to_pandas(), keys))[-1])
            if not last and parts and _same_key(parts[-1], table, keys):
                parts.append(table)
                continue
            yield from whole_segments([*parts, table.slice(0, last)])
            parts = [table.slice(last)]
        if parts:
            yield from whole_segments(parts)

    return run


def _same_key(before: pa.Table, after: pa.Table, keys: list[str]) -> bool:
    """The first table's last row and the second one's first row belong together."""
    return all(before[k][-1].as_py() == after[k][0].as_py() for k in keys)
