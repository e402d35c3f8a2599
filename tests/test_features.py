"""Account versions, maximal phrases, collocations and type-ahead, against plain versions."""

import math
import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from termtide.operators import cascades, phrases, sketches
from termtide.operators.bursts import burst_states, bursts
from termtide.operators.versions import as_of
from termtide.plans.typeahead import Fence, TermIndex
from termtide.session import new_folder

T0 = datetime(2017, 1, 1)


def plain_as_of(posts, versions):
    out = []
    for key, time, number in posts:
        known = [(t, p) for k, t, *p in versions if k is not None and k == key and t is not None and time is not None and t <= time]
        # Nulls are less than any text.
        best = max(known, key=lambda v: (v[0], [(x is not None, x or "") for x in v[1]]), default=(None, [None, None]))
        out.append((key, time, number, *best[1]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("most", [10**6, 40, 3])
def test_as_of_by_brute_force(spark, most):
    pick = random.Random(most)
    when = lambda: pick.choice([None, *[T0 + timedelta(hours=pick.randrange(400))] * 9])
    who = lambda: pick.choice([None, "a", "b", "hot", "hot", "hot", "hot", "none"])
    posts = [(who(), when(), i) for i in range(260)] + [("hot", T0 + timedelta(hours=100), 900 + i) for i in range(90)]
    versions = [(pick.choice([None, "a", "b", "hot", "hot", "other"]), when(), pick.choice([None, f"n{i}"]), f"l{i % 3}") for i in range(70)]
    versions += [("hot", T0 + timedelta(hours=100), x, "same time") for x in ("n1", None, "n2")]
    found = as_of(
        spark.createDataFrame(posts, "userid string, tweet_time timestamp, number int"),
        spark.createDataFrame(versions, "user_id string, valid_from timestamp, name string, place string"),
        ["name", "place"], most=most,
    )
    assert found.columns == ["userid", "tweet_time", "number", "name", "place"]
    assert sorted(map(tuple, found.collect()), key=repr) == plain_as_of(posts, versions)


def test_hot_accounts_are_cut(spark):
    posts = spark.range(4000).selectExpr(
        "if(id % 4 = 0, concat('u', id % 50), 'hot') userid", "timestamp_seconds(id * 60) tweet_time", "id number"
    )
    versions = spark.range(4).selectExpr("'hot' user_id", "timestamp_seconds(id * 70000) valid_from", "concat('v', id) name")
    found = as_of(posts, versions, ["name"], most=300)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(key" in plan and "range" in plan.split("hashpartitioning(key")[1][:30]
    got = found.where("userid = 'hot'").selectExpr("name", "concat('v', cast(floor(number * 60 / 70000) as int)) as due")
    assert got.where("not name <=> due").isEmpty() and got.count() == 3000
    assert found.where("userid <> 'hot' and name is not null").isEmpty()
    from termtide.operators.versions import hot_ranges

    cut = hot_ranges(posts.selectExpr("userid as key", "unix_micros(tweet_time) as micros"), 300).collect()
    assert [r.key for r in cut] == ["hot"] and len(cut[0].bounds) == 9
    assert as_of(posts.limit(0), versions, ["name"]).isEmpty() and as_of(posts, versions.limit(0), ["name"]).where("name is not null").isEmpty()


def grams(texts, sizes=(2, 3, 4, 5)):
    return [" ".join(w[i : i + n]) for w in map(str.split, texts) for n in sizes for i in range(len(w) - n + 1)]


def test_maximal_by_brute_force(spark):
    """A phrase goes if one longer phrase covers it wherever it is used."""
    pick = random.Random(3)
    texts = [" ".join(pick.choice("abc") for _ in range(pick.randrange(2, 9))) for _ in range(25)] + ["x y z", "x y z", "a a a a"]
    uses = Counter(grams(texts))
    covered = {
        g for h in uses if len(h.split()) > 2
        for g in (" ".join(h.split()[:-1]), " ".join(h.split()[1:])) if uses[g] == uses[h]
    }
    rows = spark.createDataFrame([(g,) for g in grams(texts)], "ngram string")
    got = {r.ngram: r["count"] for r in phrases.maximal(phrases.use_counts(rows)).collect()}
    assert got == {g: n for g, n in uses.items() if g not in covered}
    assert "x y z" in got and "x y" not in got and "y z" not in got
    assert phrases.maximal(phrases.use_counts(rows.limit(0))).isEmpty()


def test_collocations_by_brute_force(spark):
    pick = random.Random(4)
    pairs = [f"{pick.choice('abcde')} {pick.choice('abxyz')}" for _ in range(300)] + ["only once"]
    both, first, second = Counter(pairs), Counter(p.split()[0] for p in pairs), Counter(p.split()[1] for p in pairs)
    n = len(pairs)
    rows = spark.createDataFrame([(p,) for p in pairs], "ngram string")
    for r in phrases.collocations(rows).collect():
        k = both[f"{r.word_1} {r.word_2}"]
        a, b = first[r.word_1], second[r.word_2]
        table = [(k, a * b), (a - k, a * (n - b)), (b - k, (n - a) * b), (n - a - b + k, (n - a) * (n - b))]
        want = 2 * sum(x * math.log(x * n / e) for x, e in table if x)
        assert (r["count"], r.count_1, r.count_2, r.total) == (k, a, b, n)
        assert r.log_likelihood == pytest.approx(max(0, want), abs=1e-9)
    assert phrases.collocations(rows).count() == len(both) and phrases.collocations(rows.limit(0)).isEmpty()


@pytest.fixture(scope="module")
def index(spark):
    pick = random.Random(5)
    words = sorted({"".join(pick.choice("abcé") for _ in range(pick.randrange(1, 6))) for _ in range(500)} | {"", "b\U0010fffe"})
    counts = {w: pick.randrange(1, 60) for w in words}
    table = TermIndex(new_folder(spark, "index"), blocks=12)
    table.write(spark.createDataFrame(list(counts.items()), "ngram string, count bigint"), "ngram")
    return table, counts


def best(counts, prefix, n):
    return sorted(((t, c) for t, c in counts.items() if t.startswith(prefix)), key=lambda r: (-r[1], r[0].encode()))[:n]


def test_completions_by_brute_force(spark, index):
    table, counts = index
    for prefix in ("", "a", "ab", "b", "bé", "é", "éé", "abc", "d", "\U0010ffff"):
        for n in (1, 4):
            assert [tuple(r) for r in table.complete(spark, prefix, n).collect()] == best(counts, prefix, n)
    asked = ["", "a", "ab", "é", "d", None, "a", "cab"]
    got = {}
    for r in table.complete_many(spark.createDataFrame([(p,) for p in asked], "prefix string"), 3).collect():
        got.setdefault(r.prefix, {})[r.place] = (r.term, r["count"])
    assert got == {p: dict(enumerate(best(counts, p, 3), 1)) for p in set(asked) - {None, "d"} if best(counts, p, 3)}
    assert table.complete_many(spark.createDataFrame([("d",)], "prefix string")).isEmpty()


def test_a_prefix_opens_its_blocks(spark, index):
    table, counts = index
    fences = table.fences(spark)
    assert len(fences) == 12 and [f.first for f in fences] == sorted(f.first for f in fences)
    assert all(a.last < b.first for a, b in zip(fences, fences[1:]))
    opened = table.complete(spark, "abc", 3).inputFiles()
    blocks = {f.split("block=")[1].split("/")[0] for f in opened}
    assert blocks <= {str(f.block) for f in fences if f.last >= "abc" and f.first < "abd"} and len(blocks) <= 2
    # For all terms only blocks with a count that can be among the best are opened.
    top = sorted((f.most for f in fences), reverse=True)
    assert set(table.blocks_of(spark, "", 2)) == {f.block for f in fences if f.most >= top[1]}
    assert max(counts.values()) == top[0] and isinstance(fences[0], Fence)


def test_a_large_block_is_written_by_several_tasks(spark, monkeypatch):
    from termtide.plans import typeahead

    monkeypatch.setattr(typeahead, "BLOCK_BYTES", 1000)
    table = TermIndex(new_folder(spark, "index"), blocks=2)
    table.write(spark.range(3000).selectExpr("md5(cast(id as string)) as ngram", "id as count"), "ngram")
    fences = table.fences(spark)
    assert len(fences) == 2 and fences[0].last < fences[1].first
    assert len(table._scan(spark).inputFiles()) > 20


def test_an_empty_index(spark):
    table = TermIndex(new_folder(spark, "index"))
    table.write(spark.createDataFrame([], "ngram string, count bigint"), "ngram")
    assert table.fences(spark) == [] and table.complete(spark, "a").isEmpty()
    assert table.complete_many(spark.range(1).select(F.lit("a").alias("prefix"))).isEmpty()


def test_roots_by_brute_force(spark):
    pick = random.Random(6)
    up = {str(i): pick.choice([None, "", str(pick.randrange(130)), str(max(0, i - 1))]) for i in range(110)}
    up |= {"200": "201", "201": "202", "202": "200", "203": "200", "204": "204", "205": "gone"}
    up |= {str(1000 + i): str(999 + i) for i in range(1, 70)} | {"1000": None}
    want = {}
    for post in up:
        at, seen = post, [post]
        while up[at] and up[at] in up and up[at] not in seen:
            at = up[at]
            seen.append(at)
        want[post] = (None, None) if up[at] and up[at] in seen else (at, len(seen) - 1)
    rows = [(i, "", None, u, 1, i) for i, u in up.items()] + [(None, "", None, "1", 1, None)]
    posts = spark.createDataFrame(
        rows, "tweetid string, retweet_tweetid string, quoted_tweet_tweetid string, in_reply_to_tweetid string, like_count int, x string"
    )
    found = cascades.roots(posts)
    assert {r.tweetid: (r.root, r.depth) for r in found.collect()} == want
    assert cascades.roots(posts.limit(0)).isEmpty()
    posts = posts.selectExpr("*", "1 as quote_count", "cast(null as int) as reply_count", "2 as retweet_count")
    sizes = Counter(root for root, _ in want.values() if root)
    got = {r.root: (r.posts, r.total_quote_count, r.total_reply_count) for r in cascades.cascade_totals(posts, found).collect()}
    assert got == {root: (n, n, None) for root, n in sizes.items()}


def test_sketches_merge(spark):
    rows = spark.range(60_000).selectExpr(
        "concat('t', id % 3) hashtag", "concat('0', 1 + id % 4, '-2017') tweet_month", "if(id % 11 = 0, null, cast(id % 20011 as string)) userid"
    )
    months = [sketches.accounts_by_month(rows.where(f"crc32(userid) % 2 = {k} or userid is null"), "hashtag") for k in (0, 1)]
    exact = {r.hashtag: r.n for r in rows.groupBy("hashtag").agg(F.count_distinct("userid").alias("n")).collect()}
    found = {r.hashtag: r.accounts for r in sketches.estimated(sketches.merged(*months, keys=["hashtag"])).collect()}
    assert found.keys() == exact.keys() and all(abs(found[t] - n) <= sketches.BOUND * n for t, n in exact.items())
    small = spark.createDataFrame(rows.limit(300).collect(), rows.schema)
    few = sketches.estimated(sketches.accounts_by_month(small, "hashtag")).collect()
    true = {(r.hashtag, r.tweet_month): r.n for r in small.groupBy("hashtag", "tweet_month").agg(F.count_distinct("userid").alias("n")).collect()}
    assert {(r.hashtag, r.tweet_month): r.accounts for r in few} == true
    assert sketches.merged(months[0].limit(0), keys=["hashtag"]).isEmpty()


def test_bursts_by_brute_force(spark):
    """The cheapest of all state sequences."""
    import itertools

    pick = random.Random(7)
    counts = {(t, m): pick.choice([0, 1, 3, 9 if t == "a" else 2]) for t in "abc" for m in range(9) if m != 4}
    rows = [(f"{1 + (9 + m) % 12:02d}-{2016 + (9 + m) // 12}", t, n) for (t, m), n in counts.items() if n]
    view = spark.createDataFrame(rows, "tweet_month string, hashtag string, count long")
    # The series begins with the first month that has a use and ends with the last.
    used = [m for (_, m), n in counts.items() if n]
    months, total = range(min(used), max(used) + 1), sum(counts.values())
    found = burst_states(view, "hashtag")
    for r in found.collect():
        low = sum(n for (t, _), n in counts.items() if t == r.hashtag) / total
        rates = (low, max(low, min(2 * low, 0.5)))

        def cost(states, term=r.hashtag, rates=rates):
            out = sum(b > a for a, b in zip((0, *states), states)) * 1.0
            for m, s in zip(months, states):
                n, d = counts.get((term, m), 0), sum(counts.get((t, m), 0) for t in "abc")
                out -= n * math.log(rates[s]) + (d - n) * math.log(1 - rates[s])
            return out

        best = min(itertools.product((0, 1), repeat=len(months)), key=cost)
        assert r.cost == pytest.approx(cost(best)) and cost(tuple(map(int, r.states))) == pytest.approx(cost(best))
    shown = spark.createDataFrame([("x", "11-2016", "0110010111"), ("y", "01-2017", "000"), ("z", "12-2017", "1")], "t string, first_month string, states string")
    got = sorted(map(tuple, bursts(shown, "t").collect()))
    assert got == [("x", "04-2017", 1), ("x", "06-2017", 3), ("x", "12-2016", 2), ("z", "12-2017", 1)]
    alone = burst_states(spark.createDataFrame([("01-2017", "a", 5)], view.schema), "hashtag").collect()
    assert [(r.states, r.cost) for r in alone] == [("0", 0.0)] and burst_states(view.limit(0), "hashtag").isEmpty()
