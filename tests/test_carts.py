"""Abandoned carts as a stream (R2): state, timers, restarts, equality with the batch form."""

import datetime as dt
import random

import pytest

from tidemark.operators.explore import open_carts
from tidemark.schemas import BRONZE_SCHEMA
from tidemark.streaming.carts import PURCHASE, decided, thinned
from tidemark.streaming.jobs import start_carts

T0 = dt.datetime(2024, 1, 1, 10)
HOUR = 3600


def abandoned(events, after, now):
    """By definition: events are (time, bought) of one pair."""
    return sorted({t for t, b in events if not b and t + after <= now and not any(
        (u > t or (c and u == t)) and u <= t + after for u, c in events)})


@pytest.mark.parametrize("seed", range(30))
def test_thinned_state_decides_like_the_whole_history(seed):
    """Events in disorder within the delay, cut into batches; late ones never come."""
    rng = random.Random(seed)
    after, delay = rng.choice([(10, 0), (10, 3), (7, 25), (50, 10)])
    events = [(rng.randrange(300), rng.random() < 0.3) for _ in range(rng.choice([5, 40, 200]))]
    arrival = sorted(events, key=lambda e: e[0] + rng.uniform(0, delay))
    state, out, now, top = [], [], -1, -1
    while arrival:
        n = rng.randint(1, 12)
        batch, arrival = arrival[:n], arrival[n:]
        batch = [e for e in batch if e[0] > now]
        top = max([top, *(t for t, _ in batch)])
        gone, state = decided(thinned(state + thinned(batch, after), after), after, now)
        out += gone
        now = max(now, top - delay - 1)
        gone, state = decided(thinned(state, after), after, now)   # a timer or the empty batch
        out += gone
        assert len(state) <= 2 * (delay // after + 2)
    seen = [e for e in events]
    assert sorted(out) == abandoned(seen, after, now)


def rows_of(spark, items, n):
    """(user, product, type, minute) as silver rows."""
    rows = []
    for k, (user, product, etype, minute) in enumerate(items):
        at = T0 + dt.timedelta(minutes=minute)
        rows.append({"event_id": f"e{n}-{k}", "user_id": user, "product_id": product, "event_type": etype,
                     "event_time": at, "producer_time": at, "topic": "orders" if etype == PURCHASE else "user",
                     "partition": 0, "offset": n * 1000 + k, "kafka_timestamp": at})
    return spark.createDataFrame([tuple(r.get(c) for c in BRONZE_SCHEMA.names) for r in rows], BRONZE_SCHEMA)


class Shop:
    """One folder per topic, one start of the job per batch."""

    def __init__(self, spark, root):
        self.spark, self.root, self.n, self.items = spark, root, 0, []
        for name in ("user", "orders"):
            spark.createDataFrame([], BRONZE_SCHEMA).write.parquet(f"{root}/{name}")

    def run(self, items):
        self.n += 1
        self.items += items
        for name, mine in (("user", [i for i in items if i[2] != PURCHASE]),
                           ("orders", [i for i in items if i[2] == PURCHASE])):
            if mine:
                rows_of(self.spark, mine, self.n).coalesce(1).write.mode("append").parquet(f"{self.root}/{name}")
        q = start_carts(self.spark, [f"{self.root}/user", f"{self.root}/orders"], f"{self.root}/carts", None,
                        {"availableNow": True}, delay="5 minutes", state_partitions=2)
        q.awaitTermination()
        assert q.exception() is None
        return q.lastProgress["stateOperators"][0]["numRowsTotal"] if q.lastProgress else None

    def carts(self):
        return sorted((r.user_id, r.product_id, (r.added_at - T0).seconds // 60)
                      for r in self.spark.read.parquet(f"{self.root}/carts").collect())


def test_timeouts_purchases_and_state_over_restarts(spark, workdir):
    shop = Shop(spark, workdir)
    add, buy = "add_to_cart", PURCHASE
    shop.run([("u", "p", add, 0), ("u", "q", add, 1), ("v", "p", add, 2), ("w", "w", buy, 2), ("u", "p", "view", 3)])
    assert shop.carts() == []
    shop.run([("u", "p", buy, 30), ("v", "p", add, 40), ("w", "w", buy, 40)])
    shop.run([("x", "x", add, 66), ("w", "w", buy, 66)])        # watermark 61: the timer of (u, q) is due
    shop.run([("x", "x", add, 67), ("w", "w", buy, 67)])
    assert shop.carts() == [("u", "q", 1)]
    shop.run([("v", "p", add, 3), ("u", "q", add, 20)])         # late: ignored
    state = shop.run([("z", "z", buy, 500), ("y", "y", add, 500)])
    assert shop.carts() == [("u", "q", 1), ("v", "p", 40), ("x", "x", 67)]
    assert state <= 2                                           # only the last pairs are left
    shop.run([("z", "z", buy, 900), ("y", "y", add, 900)])
    assert shop.carts()[-1] == ("y", "y", 500)


def test_stream_equals_open_carts(spark, workdir):
    rng = random.Random(4)
    shop, items = Shop(spark, workdir), []
    for k in range(120):
        etype = rng.choice(["add_to_cart", "add_to_cart", PURCHASE, "view"])
        items.append((f"u{rng.randrange(6)}", f"p{rng.randrange(4)}", etype, k * 3))
    items += [("last", "add", "add_to_cart", 400), ("last", "buy", PURCHASE, 400)]
    for part in (items[:40], items[40:41], items[41:100], items[100:]):
        shop.run(part)
    got = shop.carts()
    pair = {}
    for u, p, etype, m in items:
        if etype != "view":
            pair.setdefault((u, p), []).append((m, etype == PURCHASE))
    assert got == sorted((u, p, t) for (u, p), e in pair.items() for t in abandoned(e, 60, 395))
    # batch carts that are open since an hour before the watermark: exactly the stream's last word on a pair
    last = {(u, p): t for u, p, t in got}
    batch = {(r.user_id, r.product_id): (r.added_at - T0).seconds // 60
             for r in open_carts(rows_of(spark, items, 99), "65 minutes").collect()
             if (r.added_at - T0).seconds // 60 + 60 <= 395}
    moved_on = {k for k, t in last.items() if any(m > t or (b and m == t) for m, b in pair[k])}
    assert batch == {k: t for k, t in last.items() if k not in moved_on}
    assert len(batch) > 5 and moved_on


def test_pairs_share_buckets_of_state(spark, workdir):
    """A bucket costs the state calls of one key, however many pairs it holds."""
    from tidemark.streaming.carts import BUCKETS
    add, buy = "add_to_cart", PURCHASE
    users = [f"u{k}" for k in range(3 * BUCKETS)]
    shop = Shop(spark, workdir)
    # an add, closed for every third user by a purchase, for another third by a further add
    shop.run([(u, "p", add, 0) for u in users] + [(None, "p", add, 1), ("u0", None, add, 1)]
             + [(u, "p", buy, 20) for u in users[::3]] + [(u, "p", add, 25) for u in users[1::3]])
    keys = spark.read.format("statestore").option("stateVarName", "times").load(f"{workdir}/carts/_checkpoint")
    assert 1 < keys.select("key").distinct().count() <= BUCKETS < len(users)
    shop.run([("z", "z", buy, 500), ("y", "y", add, 500)])
    by_key = lambda r: tuple(str(c) for c in r)
    got = sorted([(r.user_id, r.product_id, (r.added_at - T0).seconds // 60)
                  for r in spark.read.parquet(f"{workdir}/carts").collect()], key=by_key)
    assert got == sorted([(u, "p", 25) for u in users[1::3]] + [(u, "p", 0) for u in users[2::3]]
                         + [(None, "p", 1), ("u0", None, 1)], key=by_key)
