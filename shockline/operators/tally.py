"""Counts and means over all pairs of a shock and a price, without making the pairs.

Points of a pair are a sum of what the shock gives, what the price gives and what the days between them give. For a price and
a day of shocks that sum grows with the shock's share, so a binary search over the day's sorted shares finds how many pairs
reach a bound; it adds in the order in which a signal's points are added, so it decides as each pair alone would. Sums of
rounded strengths are whole hundredths: those of both sides, and one more where the two fractions reach one, which is a search
over sorted fractions; sums nearer to a border than EPS are rounded one by one, as decimals. Pairs of few rows, and of days on
which the interval begins or ends within the day, are compared in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import LookAhead, SignalPolicy
from ..functions import scoring
from . import associate

#: Pairs that are compared at once, and up to which a block isn't searched.
PAIRS = 1 << 16
EPS = 1e-9
LEVELS = ("HIGH", "MEDIUM", "LOW", "INSUFFICIENT_EVIDENCE")


def hundredths(x: np.ndarray) -> np.ndarray:
    """Half up on the decimal digits, as the strength of one signal is rounded."""
    known, place = np.unique(x, return_inverse=True)
    exact = [int(Decimal(repr(v)).quantize(Decimal("0.01"), ROUND_HALF_UP).scaleb(2)) for v in known.tolist()]
    return np.array(exact, np.int64)[place]


def _added(share, price: list[np.ndarray], near):
    """A signal's points, in the order of scoring.components."""
    return (((share + price[0]) + price[1]) + near) + price[2]


def _compared(share, near, meets, price, bounds, rounded):
    x = _added(share[None, :], [p[:, None] for p in price], near)
    out = [meets.sum(1), *((meets & (x >= b)).sum(1) for b in bounds)]
    if rounded:
        t = 100 * x + 0.5
        h = np.floor(t).astype(np.int64)
        unsure = meets & (np.abs(t - np.rint(t)) < EPS)
        h[unsure] = hundredths(x[unsure])
        out.append(np.where(meets, h, 0).sum(1))
    return out


def _searched(share, near, price, bounds, rounded):
    """The same where each shock meets each price and `near` is one number."""
    v, times = np.unique(share, return_counts=True)
    n, up_to = len(price[0]), np.r_[0, np.cumsum(times)]
    out = [np.full(n, up_to[-1])]
    for b in bounds:
        lo, hi = np.zeros(n, np.int64), np.full(n, len(v))
        while (is_open := lo < hi).any():
            mid = np.minimum((lo + hi) // 2, len(v) - 1)
            reached = _added(v[mid], price, near) >= b
            lo, hi = np.where(is_open & ~reached, mid + 1, lo), np.where(is_open & reached, mid, hi)
        out.append(up_to[-1] - up_to[lo])
    if rounded:
        whole = np.floor(100 * v)
        order = np.argsort(100 * v - whole, kind="stable")
        v, times, whole = v[order], times[order], whole[order].astype(np.int64)
        part, up_to = 100 * v - whole, np.r_[0, np.cumsum(times)]
        a = 100 * _added(0.0, price, near) + 0.5
        own = np.floor(a)
        rest, own = a - own, own.astype(np.int64)
        carried = np.searchsorted(part, 1 - rest, "left")
        total = up_to[-1] * own + (times * whole).sum() + up_to[-1] - up_to[carried]
        for low, high in ((-1.0, EPS), (1 - EPS, 1 + EPS), (2 - EPS, 3.0)):  # where the fractions add up to nearly a whole number
            first, last = np.searchsorted(part, low - rest, "left"), np.searchsorted(part, high - rest, "right")
            many = last - first
            if many.any():
                i = np.repeat(np.arange(n), many)
                j = np.arange(len(i)) - np.repeat(np.cumsum(many) - many, many) + first[i]
                off = hundredths(_added(v[j], [p[i] for p in price], near)) - (whole[j] + own[i] + (j >= carried[i]))
                np.add.at(total, i, times[j] * off)
        out.append(total)
    return out


def per_price(shocks: dict[str, np.ndarray], prices: dict[str, np.ndarray], policy: SignalPolicy, bounds: tuple[float, ...], rounded: bool) -> np.ndarray:
    """For each price: how many shocks it follows, how many of these pairs reach each bound, and with rounded the sum of the strengths in hundredths.

    shocks: at, end, day, share; prices: at, day and three shares. A row of the result for each of these.
    """
    n = len(prices["at"])
    out = np.zeros((1 + len(bounds) + rounded, n), np.int64)
    near = lambda days: policy.temporal * np.maximum(0.0, 1 - days / float(policy.lookahead_days))

    def compared(i: np.ndarray, j: np.ndarray) -> None:
        step = max(1, PAIRS // len(j))
        for k in range(0, len(i), step):
            some = i[k : k + step]
            at = prices["at"][some][:, None]
            meets = (shocks["at"][j][None, :] <= at) & (at <= shocks["end"][j][None, :])
            days = prices["day"][some][:, None] - shocks["day"][j][None, :]
            out[:, some] += _compared(shocks["share"][j], near(days), meets, [prices[c][some] for c in ("share0", "share1", "share2")], bounds, rounded)

    every = np.arange(len(shocks["at"]))
    if n * len(every) <= PAIRS:
        compared(np.arange(n), every)
        return out
    for day in np.unique(prices["day"]):
        i = np.flatnonzero(prices["day"] == day)
        price = [prices[c][i] for c in ("share0", "share1", "share2")]
        begins, ends = prices["at"][i].min(), prices["at"][i].max()
        for before in np.unique(shocks["day"]):
            j = np.flatnonzero(shocks["day"] == before)
            if shocks["at"][j].min() > ends or shocks["end"][j].max() < begins:
                continue
            if shocks["at"][j].max() <= begins and ends <= shocks["end"][j].min():
                out[:, i] += _searched(shocks["share"][j], near(int(day) - int(before)), price, bounds, rounded)
            else:
                compared(i, j)
    return out


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict[str, np.ndarray], dict[str, np.ndarray]]]:
    for b in batches:
        sides = []
        for name in ("shocks", "prices"):
            held = b.column(name)
            offsets, fields = held.offsets.to_numpy(), held.values
            sides.append((offsets, {f.name: fields.field(f.name).to_numpy(zero_copy_only=False) for f in fields.type}))
        for k in range(b.num_rows):
            yield tuple({c: v[o[k] : o[k + 1]] for c, v in s.items()} for o, s in sides)


def _blocks(shocks: DataFrame, prices: DataFrame, ahead: LookAhead, policy: SignalPolicy) -> DataFrame:
    """prices: judged rows. What is null is 0 and not known."""
    control = F.col("control_difference_pct") if "control_difference_pct" in prices.columns else F.lit(None).cast("double")
    parts = scoring.components(policy, F.col("shock_severity"), F.col("deviation_pct"), F.col("robust_z_score"), F.lit(0), control)
    trust = F.col("data_confidence")
    own = {
        "share0": parts["price_decline"], "share1": parts["robust_abnormality"], "share2": parts["control_difference"], "enough": trust["is_sufficient"].cast("int"),
    }
    for name, c in {"value": trust["value"], "deviation": F.col("deviation_pct"), "z": F.col("robust_z_score")}.items():
        own |= {name: F.coalesce(c, F.lit(0.0)), f"{name}_known": c.isNotNull()}
    return associate.blocks(shocks, prices, ahead, {"share": parts["shock_severity"]}, own)


def level_counts(shocks: DataFrame, prices: DataFrame, ahead: LookAhead, policy: SignalPolicy) -> DataFrame:
    """signal_level and n of all signals of shocks and judged prices."""
    bounds = scoring.least_points(policy.high), scoring.least_points(policy.medium)

    def counted(batches):
        total = np.zeros(4, np.int64)
        for s, p in _rows(batches):
            n, high, medium = per_price(s, p, policy, bounds, False)
            enough = p["enough"] == 1
            total += [high[enough].sum(), (medium - high)[enough].sum(), (n - medium)[enough].sum(), n[~enough].sum()]
        yield pa.RecordBatch.from_arrays([pa.array(LEVELS), pa.array(total)], ["signal_level", "n"])

    found = _blocks(shocks, prices, ahead, policy).mapInArrow(counted, "signal_level string, n long")
    return found.where("n > 0").groupBy("signal_level").agg(F.sum("n").alias("n"))


def metrics(shocks: DataFrame, prices: DataFrame, ahead: LookAhead, policy: SignalPolicy) -> DataFrame:
    """quality.dashboard_metrics of all signals of shocks and judged prices."""
    names = ["strength", "strengths", "value", "values", "deviation", "deviations", "z", "zs"]

    def summed(batches):
        whole, real = np.zeros(5, np.int64), np.zeros(3)
        for s, p in _rows(batches):
            n, h = per_price(s, p, policy, (), True)
            enough = p["enough"] == 1
            whole[:2] += [h[enough].sum(), n[enough].sum()]
            for k, c in enumerate(("value", "deviation", "z")):
                real[k] += (n * p[c])[known := p[c + "_known"] & (n > 0)].sum()
                whole[2 + k] += n[known].sum()
        held = [whole[0], whole[1], real[0], whole[2], real[1], whole[3], real[2], whole[4]]
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in held], names)

    kinds = ", ".join(f"{c} {'double' if c in ('value', 'deviation', 'z') else 'long'}" for c in names)
    found = _blocks(shocks, prices, ahead, policy).mapInArrow(summed, kinds)
    mean = lambda c, many, scale=1: F.try_divide(F.sum(c) / scale, F.sum(many))
    return found.agg(
        mean("strength", "strengths", 100).alias("avg_signal_strength"), mean("value", "values").alias("avg_confidence"),
        mean("deviation", "deviations").alias("avg_deviation_pct"), mean("z", "zs").alias("avg_robust_z_score"),
    )
