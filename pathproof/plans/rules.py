"""Detection rules.

A run rule asks whether an order has, before pickup, six pings of which the last
five all match. An order sees a contiguous stretch of its driver's pings, so the
answer does not need the pings of each order: the runs are found once per driver,
each as a short span [first ping, last ping], and an order is hit when its window
holds a span: a semi join with the few spans, where the plain way would produce every
ping of every order.

Orders stored with several rows (repeated assignment records) are the exception:
their rows see the same pings several times and the counts add up. They take the
long way, order by order, through the same span search.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pathproof.functions import earth_distance_km, fraction_digits_of, round7_of, whole_seconds_between
from pathproof.operators import HOUR, holding_each, interval_join, made_once, neighbours, smallest_ends, with_slot
from pathproof.operators.intervals import Range
from pathproof.operators.slots import SLOT
from pathproof.plans.measures import ORDER_COLUMNS, PING_FEATURES, distinct_pings, in_slots, with_measures

GROUP = ("order_date", "order_id", "driver_id", "service_type")

ACCURACY_ROW = ("ping_time", "upload_time", "accuracy")
FULL_ROW = ("ping_time", "upload_time", "latitude", "longitude", "speed_kmh", "accuracy", "head")

RUN = 5


@dataclass(frozen=True)
class RunRule:
    """Five pings in a row match, the one before them being any ping."""

    code: str
    match: str
    net: str | None = None
    flag_at: int = 1
    row: tuple[str, ...] = ACCURACY_ROW


@dataclass(frozen=True)
class SpeedRule:
    """At least ``times`` pings at one of the speeds of one group."""

    code: str
    speeds: tuple[tuple[float, ...], ...]
    times: int = 3
    net: str | None = None
    flag_at: int = 1


@dataclass(frozen=True)
class JumpRule:
    """The next ping is far away, precise, and ``gap_s`` seconds later.

    ``exact`` asks for a gap of that many whole seconds, otherwise for at most that many.
    """

    code: str
    km: float = 1.0
    accuracy_below: float = 20
    gap_s: int = 5
    exact: bool = True
    net: str | None = None
    flag_at: int = 3


Rule = RunRule | SpeedRule | JumpRule

# Rule codes, whole metres of accuracy they look for, thresholds.
_LONG_ACCURACY = {"109": 4, "111": 0, "112": 1, "113": 7, "114": 3}
_LONG_ACCURACY_AND_SPEED = {"209": 4, "211": 0, "212": 1, "213": 7, "214": 3}

RULES: dict[str, Rule] = {
    r.code: r
    for r in [
        JumpRule("006"),
        SpeedRule("008", ((0.36, 3.6), (0.72, 7.2), (10.8,))),
        RunRule("010", "lat_digit > 7 and lon_digit > 7", row=FULL_ROW),
        RunRule("016", "round_accuracy = 1 and acc_digit < 5", net="round_accuracy = 1", flag_at=3),
        RunRule("017", "round_accuracy = 0 and acc_digit < 5", net="round_accuracy = 0"),
        *[
            RunRule(code, f"round_accuracy = {m} and acc_digit >= 5", net="acc_digit >= 5")
            for code, m in _LONG_ACCURACY.items()
        ],
        RunRule("115", "acc_digit >= 5", net="acc_digit >= 5", flag_at=3),
        *[
            RunRule(code, f"round_accuracy = {m} and acc_digit >= 5 and speed_digit >= 5")
            for code, m in _LONG_ACCURACY_AND_SPEED.items()
        ],
        RunRule("215", "acc_digit >= 5 and speed_digit >= 5"),
    ]
}


# ---------------------------------------------------------------- spans of pings

# Counters of several rules share one number: six bits each, ten to a number. A count
# is cut at 6, which cannot turn into the sum of 5 a run needs, and five cut counts
# add up to 30 at most, so counters never run into each other.
_BITS = 6
_PER_WORD = 10
_TOO_MANY = RUN + 1


def _present(df: DataFrame, names: Iterable[str]) -> list[str]:
    return [c for c in names if c in df.columns]


def _unique(*names: str) -> list[str]:
    return list(dict.fromkeys(names))


def run_spans(
    pings: DataFrame, key: str, rules: Sequence[RunRule], about: Sequence[str] = (), width_s: int = HOUR
) -> DataFrame:
    """Spans (``whats``, ``start``, ``end``) of six rows whose last five carry five matches.

    ``pings`` are distinct feature rows. Rows equal in ``rule.row`` become one row that
    carries all their matches, and rows equal in ping and upload time share the matches
    of all of them: this is what a running count that includes its peers, taken before
    the rows are made distinct, amounts to. All ``rules`` share ``row``.
    """
    identity = _unique(*_present(pings, rules[0].row), *about)
    time = _unique("ping_time", "upload_time", *about)
    matches = [f"_m{r.code}" for r in rules]
    rows = _slotted(pings, key, width_s).select(
        key, SLOT, *identity, *[F.expr(r.match).cast("int").alias(m) for r, m in zip(rules, matches)]
    )
    if about or not set(_present(pings, PING_FEATURES)) <= set(identity):  # else the rows are distinct as they come
        rows = rows.groupBy(key, SLOT, *identity).agg(*[F.sum(m).alias(m) for m in matches])
    rows = (
        rows.groupBy(key, SLOT, *time)
        .agg(F.count(F.lit(1)).alias("_rows"), *[F.sum(m).alias(m) for m in matches])
    )
    words = {f"_w{i}": matches[i * _PER_WORD : (i + 1) * _PER_WORD] for i in range(-(-len(rules) // _PER_WORD))}
    # Beyond six, further rows of one time do not change which five rows can follow another.
    rows = rows.select(
        key,
        SLOT,
        *time,
        *[_packed(ms).alias(w) for w, ms in words.items()],
        F.explode(F.sequence(F.lit(1), F.least(F.col("_rows"), F.lit(_TOO_MANY)).cast("int"))).alias("_copy"),
    ).withColumns({w: F.when(F.col("_copy") == 1, F.col(w)).otherwise(F.lit(0)) for w in words})
    whats = F.array_compact(
        F.array(
            *[
                F.when(
                    F.shiftright(f"_sum{i // _PER_WORD}", _BITS * (i % _PER_WORD)).bitwiseAND(2**_BITS - 1) == RUN,
                    F.lit(r.code),
                )
                for i, r in enumerate(rules)
            ]
        )
    )
    looked = neighbours(
        rows,
        [key],
        [*time, "_copy"],
        RUN,
        keep=F.col("_end").isNotNull() & (F.size(whats) > 0),
        ahead={
            "_end": lambda w: F.lead("ping_time", RUN).over(w),
            **{f"_sum{i}": _sum_of_next(word) for i, word in enumerate(words)},
        },
    )
    return looked.select(key, *about, whats.alias("whats"), F.col("ping_time").alias("start"), F.col("_end").alias("end"))


def _slotted(pings: DataFrame, key: str, width_s: int) -> DataFrame:
    """``pings`` with a slot; those that have one are partitioned by key and slot already."""
    return pings if SLOT in pings.columns else with_slot(pings, "ping_time", width_s).repartition(key, SLOT)


def _packed(matches: Sequence[str]) -> Column:
    lanes = [
        F.shiftleft(F.least(F.coalesce(F.col(m), F.lit(0)), F.lit(_TOO_MANY)).cast("bigint"), _BITS * i)
        for i, m in enumerate(matches)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), lanes)


def _sum_of_next(word: str):
    return lambda w: F.sum(word).over(w.rowsBetween(1, RUN))


def speed_spans(
    pings: DataFrame, key: str, rule: SpeedRule, about: Sequence[str] = (), width_s: int = HOUR
) -> DataFrame:
    """Spans from a ping at a listed speed to the ``times``-th one of the same group."""
    group = F.coalesce(
        *[F.when(F.col("speed_kmh").isin(*s), F.lit(f"{rule.code}.{i}")) for i, s in enumerate(rule.speeds)]
    )
    order = _unique(*_present(pings, FULL_ROW), *about)
    slotted = pings if SLOT in pings.columns else with_slot(pings, "ping_time", width_s)
    rows = slotted.select(key, SLOT, group.alias("what"), *order).where(F.col("what").isNotNull()).distinct()
    looked = neighbours(
        rows,
        [key, "what", *[c for c in about if c in GROUP]],
        order,
        rule.times - 1,
        keep=F.col("end").isNotNull(),
        ahead={"end": lambda w: F.lead("ping_time", rule.times - 1).over(w)},
        width_s=width_s,
    )
    return looked.select(key, *about, F.array("what").alias("whats"), F.col("ping_time").alias("start"), "end")


def jumps(
    pings: DataFrame, key: str, rule: JumpRule, about: Sequence[str] = (), width_s: int = HOUR
) -> DataFrame:
    """Pings whose next one is a jump, with distance, accuracy and time of the next one."""
    order = _unique(*_present(pings, PING_FEATURES), *about)
    next_of = {
        "next_time": "ping_time",
        "next_accuracy": "accuracy",
        "next_latitude": "latitude",
        "next_longitude": "longitude",
    }
    here_and_next = ("latitude", "longitude", "next_latitude", "next_longitude")
    distance = earth_distance_km(*[F.col(c).cast("double") for c in here_and_next])
    gap = whole_seconds_between("ping_time", "next_time")
    return neighbours(
        pings.select(key, *[c for c in (SLOT,) if c in pings.columns], *order),
        [key],
        order,
        1,
        keep=(F.col("next_accuracy") < rule.accuracy_below)
        & ((gap == rule.gap_s) if rule.exact else (gap <= rule.gap_s))
        & (distance > rule.km),
        ahead={name: _next(column) for name, column in next_of.items()},
        width_s=width_s,
    ).withColumn("distance_km", distance)


def _next(column: str):
    return lambda w: F.lead(column, 1).over(w)


def jump_spans(
    pings: DataFrame, key: str, rule: JumpRule, about: Sequence[str] = (), width_s: int = HOUR
) -> DataFrame:
    return jumps(pings, key, rule, about, width_s).select(
        key,
        *about,
        F.array(F.lit(rule.code)).alias("whats"),
        F.col("ping_time").alias("start"),
        F.col("next_time").alias("end"),
    )


def rule_spans(
    pings: DataFrame, key: str, rules: Sequence[Rule], about: Sequence[str] = (), width_s: int = HOUR
) -> DataFrame:
    """Spans of all ``rules`` in one frame; run rules over the same rows share one pass.

    ``pings`` that have a slot (``distinct_pings``) are shuffled for none of the passes.

    A span is one row with all its ``whats``: rule codes, for speed rules followed by the speed group.
    """
    parts = []
    for row in _unique(*[r.row for r in rules if isinstance(r, RunRule)]):
        same = [r for r in rules if isinstance(r, RunRule) and r.row == row]
        parts.append(run_spans(pings, key, same, about, width_s))
    parts += [speed_spans(pings, key, r, about, width_s) for r in rules if isinstance(r, SpeedRule)]
    parts += [jump_spans(pings, key, r, about, width_s) for r in rules if isinstance(r, JumpRule)]
    return reduce(DataFrame.unionByName, parts)


# ---------------------------------------------------------------- hits of orders


def order_hits(
    orders: DataFrame,
    pings: DataFrame,
    rules: Sequence[Rule],
    pad: str = "5 minutes",
    narrow: bool = False,
    one_row_per_order: bool = False,
    pings_are_distinct: bool = False,
    width_s: int = HOUR,
    within: Range | None = None,
) -> DataFrame:
    """One row (order, ``code``) per order and rule that hits it.

    ``one_row_per_order`` promises that ``order_id`` is unique in ``orders`` and saves
    the branch for the others. ``pings_are_distinct`` promises the same of the feature
    columns of ``pings`` and saves a shuffle. ``within`` is the time range of the pings.

    ``narrow`` counts pings as the per-rule queries of one region do: they make pings
    distinct in the columns the rule reads before counting, where the feature tables of
    the other region tell pings apart by all their columns.
    """
    rows = orders.select(*ORDER_COLUMNS).withColumn(
        "_from", F.col("delivery_assign_time") - F.expr(f"interval {pad}")
    )
    if narrow:
        groups: dict[tuple[str, ...], list[Rule]] = {}
        for r in rules:
            groups.setdefault(narrow_features(r), []).append(r)
        seen = [(distinct_pings(pings, features, width_s), some) for features, some in groups.items()]
    elif pings_are_distinct:
        seen = [(with_measures(_in_slots_once(pings, width_s)), rules)]
    else:
        seen = [(distinct_pings(pings, width_s=width_s), rules)]
    if one_row_per_order:
        return _hits_by_driver(rows, seen, pings, rules, width_s)
    # Rows without an order number are told apart by their driver, so that they are not one group.
    unnamed = F.when(F.col("order_id").isNull(), F.xxhash64("driver_id", "_from"))
    counted = rows.distinct().withColumn("_unnamed", unnamed)
    counted = counted.withColumn("_rows", F.count(F.lit(1)).over(Window.partitionBy("order_id", "_unnamed")))
    repeated = F.col("order_id").isNotNull() & (F.col("_rows") > 1)
    single, several = (counted.where(c).drop("_unnamed", "_rows") for c in (~repeated, repeated))
    several = _step(several, rules)
    if _is_cut(rules) and several.isEmpty():
        return _hits_by_driver(rows.distinct(), seen, pings, rules, width_s)
    by_order = [_hits_by_order(several, feature_rows, some, width_s, within) for feature_rows, some in seen]
    return reduce(DataFrame.unionByName, [_hits_by_driver(single, seen, pings, rules, width_s), *by_order])


def _is_cut(rules: Sequence[Rule]) -> bool:
    """The plan of one rule is short; that of many is cut into steps, or it outgrows the driver."""
    return len(rules) > 1


def _step(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return made_once(df) if _is_cut(rules) else df


def _code(what: Column) -> Column:
    return F.substring_index(what, ".", 1)


def narrow_features(rule: Rule) -> tuple[str, ...]:
    """Ping columns the per-rule query of a rule is distinct in."""
    if isinstance(rule, RunRule) and rule.row == ACCURACY_ROW:
        return (*ACCURACY_ROW, "speed_digit") if "speed_digit" in rule.match else ACCURACY_ROW
    return FULL_ROW


def _whats(rules: Sequence[Rule]) -> list[str]:
    return [
        w
        for r in rules
        for w in ([f"{r.code}.{i}" for i in range(len(r.speeds))] if isinstance(r, SpeedRule) else [r.code])
    ]


def _in_slots_once(pings: DataFrame, width_s: int) -> DataFrame:
    return pings if SLOT in pings.columns else in_slots(pings, width_s)


def _hits_by_driver(
    rows: DataFrame,
    seen: Sequence[tuple[DataFrame, Sequence[Rule]]],
    pings: DataFrame,
    rules: Sequence[Rule],
    width_s: int,
) -> DataFrame:
    """Orders with one row each: does the order's window hold a span of its driver, and its trip no pardon?

    ``seen`` are distinct pings with the rules that look at them. The spans of all of them are looked for in the
    windows at once. The rows of hits ask for pardons themselves, so that no trip without a hit is looked at; for
    those any of the ``pings`` will do, copies or not.
    """
    whats = _whats(rules)
    ends = [f"_end{i}" for i in range(len(whats))]
    found = [rule_spans(feature_rows, "driver_id", some, width_s=width_s) for feature_rows, some in seen]
    spans = reduce(DataFrame.unionByName, found)
    marks = spans.select(
        "driver_id", "start", *[F.when(F.array_contains("whats", what), F.col("end")).alias(e) for what, e in zip(whats, ends)]
    )
    marks = _step(marks, rules)
    windows = rows.select(*GROUP, "_from", "delivery_pickup_time", "delivery_delivered_time")
    codes = F.array_compact(
        F.array(
            *[
                F.when(F.col(e) <= F.col("delivery_pickup_time"), F.lit(what.partition(".")[0]))
                for what, e in zip(whats, ends)
            ]
        )
    )
    hits = smallest_ends(windows, marks, ["driver_id"], ends, "_from", "start", width_s).select(
        *windows.columns, F.explode(F.array_distinct(codes)).alias("code")
    )
    nets = _nets(rules)
    if nets:
        hits = _step(hits, rules)
        pardons = [f"_pardon{i}" for i in range(len(nets))]
        caught = _pardons(with_measures(pings), nets).select(
            "driver_id",
            "ping_time",
            *[F.when(F.col(f"net{i}"), F.col("ping_time")).alias(p) for i, p in enumerate(pardons)],
        )
        asked = smallest_ends(
            hits, caught, ["driver_id"], pardons, "delivery_pickup_time", "ping_time", width_s
        )
        pardoned = reduce(
            lambda a, b: a | b,
            [
                F.col("code").isin(codes) & (F.col(p) <= F.col("delivery_delivered_time"))
                for p, codes in zip(pardons, nets.values())
            ],
        )
        hits = asked.where(~(F.col("order_id").isNotNull() & F.coalesce(pardoned, F.lit(False))))
    return hits.select(*GROUP, "code").distinct()


def _hits_by_order(
    rows: DataFrame, pings: DataFrame, rules: Sequence[Rule], width_s: int, within: Range | None
) -> DataFrame:
    """Orders with several rows: span search inside each order, over all its rows together."""
    pings = pings.drop(SLOT)  # wide slots are not those of the windows
    seen = interval_join(
        rows, pings, "driver_id", "ping_time", "_from", "delivery_pickup_time", width_s=width_s, within=within
    )
    seen = _step(seen, rules)
    times = ["delivery_assign_time", "delivery_pickup_time", "delivery_delivered_time"]
    kept = ["order_date", "driver_id", "service_type", "create_time"]
    # Times of the order tell its rows apart; only the jump rule looks at rows that have them.
    found = [
        rule_spans(seen, "order_id", some, about, width_s)
        .select(*GROUP, F.explode("whats").alias("what"))
        .select(*GROUP, _code(F.col("what")).alias("code"))
        for some, about in (
            ([r for r in rules if not isinstance(r, JumpRule)], kept),
            ([r for r in rules if isinstance(r, JumpRule)], kept + times),
        )
        if some
    ]
    return _without_pardoned(reduce(DataFrame.unionByName, found).distinct(), rows, pings, rules, width_s)


def _nets(rules: Sequence[Rule]) -> dict[str, list[str]]:
    """Codes of the rules that share each net."""
    return {net: [r.code for r in rules if r.net == net] for net in _unique(*[r.net for r in rules if r.net])}


def _pardons(pings: DataFrame, nets: Iterable[str]) -> DataFrame:
    """(driver_id, ping_time, net0, net1, …) of the pings that any net catches."""
    caught = [F.coalesce(F.expr(net), F.lit(False)).alias(f"net{i}") for i, net in enumerate(nets)]
    any_net = reduce(lambda a, b: a | b, [F.col(f"net{i}") for i in range(len(caught))])
    return pings.select("driver_id", "ping_time", *caught).where(any_net)


def _without_pardoned(
    hits: DataFrame, rows: DataFrame, pings: DataFrame, rules: Sequence[Rule], width_s: int
) -> DataFrame:
    """Take back hits of orders with a pardoning ping on the trip of any of their rows."""
    nets = _nets(rules)
    if not nets:
        return hits
    names = [f"net{i}" for i in range(len(nets))]
    pardons = _pardons(pings, nets).select(
        "driver_id",
        F.explode(F.array_compact(F.array(*[F.when(F.col(n), F.lit(n)) for n in names]))).alias("net"),
        F.col("ping_time").alias("start"),
        F.col("ping_time").alias("end"),
    )
    net_of = F.coalesce(*[F.when(F.col("code").isin(codes), F.lit(n)) for n, codes in zip(names, nets.values())])
    trips = rows.select("order_id", "driver_id", "delivery_pickup_time", "delivery_delivered_time")
    pardoned = holding_each(
        trips,
        pardons,
        ["driver_id"],
        "net",
        names,
        "delivery_pickup_time",
        "delivery_delivered_time",
        width_s=width_s,
    ).select("order_id", "net")
    return hits.withColumn("net", net_of).join(pardoned, ["order_id", "net"], "left_anti").select(*GROUP, "code")


# ---------------------------------------------------------------- driver-days


def flag_orders(hits: DataFrame, flag_at: dict[str, int]) -> DataFrame:
    """Add to each hit the driver's distinct hit orders of that day, and the flag.

    The counts are joined back, not taken by a window over the driver-day: the join can
    be split when one driver-day holds most of the hits, a window partition cannot.
    """
    day = ["order_date", "driver_id", "code"]
    counts = hits.groupBy(*day).agg(F.countDistinct("order_id").alias("cnt"))
    needed = F.coalesce(*[F.when(F.col("code").isin([c for c, m in flag_at.items() if m == n]), n)
                          for n in sorted(set(flag_at.values()))])
    return hits.join(counts, day).select(
        *GROUP, "code", "cnt", (F.col("cnt") >= needed).cast("int").alias("flagged")
    )


def rule_output(flags: DataFrame, code: str) -> DataFrame:
    """Result table of one rule: one row per hit order."""
    return flags.where(F.col("code") == code).select(
        *GROUP,
        F.lit(True).alias(f"is_{code}"),
        F.col("cnt").alias(f"cnt_{code}"),
        F.col("flagged").alias(f"dsys{code}"),
        F.col("order_date").alias("grass_date"),
    )


def run_rules(orders: DataFrame, pings: DataFrame, rules: Sequence[Rule], **options) -> DataFrame:
    """All ``rules`` in one pass: (order, ``code``, ``cnt``, ``flagged``). Options as in ``order_hits``."""
    hits = _step(order_hits(orders, pings, rules, **options), rules)
    return flag_orders(hits, {r.code: r.flag_at for r in rules})


def run_rule(orders: DataFrame, pings: DataFrame, rule: Rule, **options) -> DataFrame:
    return rule_output(run_rules(orders, pings, [rule], **options), rule.code)


# ---------------------------------------------------------------- accept points


def _rounded(points: DataFrame, names: Sequence[str]) -> list[Column]:
    kinds = dict(points.dtypes)
    return [round7_of(n, kinds[n]).alias(n) for n in names]


def _all_seven(points: DataFrame, names: Sequence[str]) -> Column:
    """All of ``names`` are given with 7 decimals."""
    kinds = dict(points.dtypes)
    return reduce(lambda a, b: a & b, [fraction_digits_of(n, kinds[n]) == 7 for n in names])


def accept_at_store(points: DataFrame, code: str = "001") -> DataFrame:
    """The order was accepted exactly at the store, both given with 7 decimals."""
    names = ["accept_latitude", "accept_longitude", "store_latitude", "store_longitude"]
    exact = points.select(*GROUP, *_rounded(points, names))
    seven = _all_seven(exact, names)
    same = (F.col("accept_latitude") == F.col("store_latitude")) & (
        F.col("accept_longitude") == F.col("store_longitude")
    )
    hits = exact.where(seven & same).select(*GROUP).distinct().withColumn("code", F.lit(code))
    return rule_output(flag_orders(hits, {code: 1}), code)


def accept_point_repeated(points: DataFrame, code: str = "004", at_least: int = 3) -> DataFrame:
    """Several orders of a driver and day were accepted at one point with 7 decimals."""
    names = ["accept_latitude", "accept_longitude"]
    exact = points.select(*GROUP, "create_time", *_rounded(points, names))
    exact = exact.where(_all_seven(exact, names))
    place = ["order_date", "driver_id", *names]
    counts = (
        exact.groupBy(F.to_date("create_time").alias("order_date"), "driver_id", *names)
        .agg(F.countDistinct("order_id").alias(f"cnt_{code}"))
        .where(F.col(f"cnt_{code}") >= at_least)
    )
    return (
        exact.join(counts, place)
        .select(
            *GROUP, f"cnt_{code}", F.lit(1).alias(f"dsys{code}"), F.col("order_date").alias("grass_date")
        )
        .distinct()
    )
