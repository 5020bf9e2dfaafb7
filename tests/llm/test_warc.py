import random

from pyspark.sql import functions as F

from mdmspark.llm import warc


def test_canonical_urls(spark):
    cases = {"HTTP://Www.X.org:80/A?b=2&a=1&utm_source=q#f": "http://www.x.org/A?a=1&b=2", "https://x.org:443": "https://x.org/", "https://x.org:80/": "https://x.org:80/",
             "http://x.org/?fbclid=1": "http://x.org/", "x.org/a": "", None: "", "http://x.org?q": "http://x.org/?q"}
    df = spark.createDataFrame([(u,) for u in cases], "url string")
    assert {r.url: r.c for r in df.select("url", warc.canonical_url().alias("c")).collect()} == cases


def test_headers(spark):
    df = spark.createDataFrame([("ETag: a:b\r\nVary:x\nbroken\nvary: y",), (None,), ("",)], "headers string")
    assert [r[0] for r in df.select(warc.parse_headers()).collect()] == [{"etag": "a:b", "vary": "y"}, {}, {}]


def brute_before(rows):
    out = {}
    for key, t, full, i in rows:
        earlier = [(t2, i2) for k2, t2, f2, i2 in rows if k2 == key and f2 and t2 is not None and t is not None and t2 < t]
        if not full:
            out[i] = max(earlier)[1] if earlier else None
    return out


def test_as_of_over_many_ranges_and_a_hot_key(spark):
    rng = random.Random(7)
    rows = [("hot" if rng.random() < 0.6 else f"k{rng.randint(0, 40)}", rng.randint(0, 300), rng.random() < 0.08, i) for i in range(1500)]
    df = spark.createDataFrame(rows, "key string, ts long, full boolean, id long")
    old = spark.conf.get("spark.sql.shuffle.partitions")
    for n in ("1", "7", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = warc.latest_before(df, "key", ["key", "ts", "full", "id"], "full", "id").where("not full").collect()
        assert {r.id: r.before for r in got} == brute_before(rows)
    spark.conf.set("spark.sql.shuffle.partitions", old)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


SCHEMA = "record_id long, url string, ts long, status int, headers string, digest string"


def resolve(spark, rows, **extra):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("before", "full", "canonical_url", "outcome", "_range", "stored", "fields")})
    return {r.record_id: r for r in warc.resolve_revisits(df).collect()}


def test_outcomes_and_merged_headers(spark):
    u = "http://x.org/a"
    got = resolve(spark, [
        (1, u, 10, 200, "ETag: \"v1\"\nCache-Control: max-age=1\nContent-Length: 9", "d1"),
        (2, u + "#f", 20, 304, "ETag: W/\"v1\"\nCache-Control: no-store\nSet-Cookie: z=1", None),
        (3, u, 30, 200, "ETag: \"v2\"\nLast-Modified: then", "d2"),
        (4, u, 40, 304, "ETag: \"v1\"", None),
        (5, u, 41, 304, "Last-Modified: then", None),
        (6, u, 42, 304, "Date: now", None),
        (7, u, 43, 304, None, "d2"),
        (8, u, 10, 304, "ETag: \"v1\"", None),
        (9, "http://x.org/b", 50, 304, "ETag: \"v1\"", None),
        (10, None, 50, 304, "ETag: \"v1\"", None),
        (11, u, None, 304, "ETag: \"v1\"", None),
        (12, u, 60, 404, None, None),
    ])
    assert {i: (r.outcome, r.refers_to) for i, r in got.items()} == {
        2: ("resolved", 1), 4: ("mismatch", 3), 5: ("resolved", 3), 6: ("unverified", 3), 7: ("resolved", 3), 8: ("orphan", None), 9: ("orphan", None),
        10: ("orphan", None), 11: ("orphan", None)}
    assert got[2].headers == 'cache-control: no-store\ncontent-length: 9\netag: W/"v1"' and got[2].digest == "d1"
    assert got[4].headers is None and got[4].digest is None


def test_repeated_rows_and_an_empty_table(spark):
    rows = [(1, "http://x/", 1, 200, None, "d"), (1, "http://x/", 1, 200, None, "d"), (2, "http://x/", 2, 304, None, "d"), (2, "http://x/", 2, 304, None, "d"), (None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert [(r.record_id, r.outcome, r.refers_to) for r in warc.resolve_revisits(df).collect()] == [(2, "resolved", 1)] * 2
    assert warc.resolve_revisits(df.limit(0)).count() == 0


def brute_resolve(rows):
    """(record_id, url, ts) of each revisit with its response's record_id and
    outcome, by a look at every response of its url."""
    out = []
    for i, u, t, status, headers, _ in rows:
        if status != 304:
            continue
        full = [(t2, i2 is not None, i2, n) for n, (i2, u2, t2, s2, _, _) in enumerate(rows) if s2 == 200 and u2 == u and None not in (u, t, t2) and t2 < t]
        best = rows[max(full)[3]] if full else None
        tag = dict(h.split(": ", 1) for h in (headers or "").split("\n") if h).get("ETag")
        stored = dict(h.split(": ", 1) for h in (best[4] or "").split("\n") if h).get("ETag") if best else None
        outcome = "orphan" if not best else "unverified" if None in (tag, stored) else "resolved" if tag == stored else "mismatch"
        out.append((str(i), str(u), t, outcome, str(best[0]) if best else "None"))
    return sorted(out, key=repr)


def test_repeated_null_and_text_ids(spark):
    rng = random.Random(3)
    rows = []
    for n in range(400):
        full = rng.random() < 0.4
        u = rng.choice(["http://x/a", "http://x/b", f"http://x/{rng.randint(0, 30)}", None])
        # Equal urls, times and ids are equal records, so any of them will do.
        i, t = rng.choice([None, f"id{rng.randint(0, 9)}", f"only{n}"]), rng.randint(0, 60)
        rows.append((i, u, t, 200 if full else 304, f"ETag: {hash((i, u, t)) % 3}" if rng.random() < 2 else None, None))
    for kind, ids in (("string", [r[0] for r in rows]), ("long", [None if r[0] is None else sum(r[0].encode()) % 40 for r in rows])):
        typed = [(i, u, t, s, f"ETag: {len(str(i)) % 2}", None) for i, (_, u, t, s, _, _) in zip(ids, rows)]
        df = spark.createDataFrame(typed, SCHEMA.replace("record_id long", f"record_id {kind}"))
        for n in ("1", "9"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got = warc.resolve_revisits(df).collect()
            assert sorted(((str(r.record_id), r.canonical_url or "None", r.ts, r.outcome, str(r.refers_to)) for r in got), key=repr) == brute_resolve(typed)
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_as_many_rows_as_revisits(spark):
    a, b = "http://x/a", "http://x/b"
    rows = [(1, a, 1, 200, "ETag: a", "da"), (1, b, 1, 200, "ETag: b", "db"), (7, a, 2, 304, "ETag: a", None), (7, b, 2, 304, "ETag: b", None), (None, b, 3, 304, "ETag: b", None)]
    got = warc.resolve_revisits(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.record_id or 0, r.canonical_url, r.outcome, r.refers_to, r.digest) for r in got) == [
        (0, b, "resolved", 1, "db"), (7, a, "resolved", 1, "da"), (7, b, "resolved", 1, "db")]


def test_values_of_other_types_over_small_batches(spark):
    rng = random.Random(9)
    rows = [(rng.choice(["k1", "k2", "k3"]), rng.randint(0, 500), rng.random() < 0.2, f"v{i}") for i in range(900)]
    df = spark.createDataFrame(rows, "key string, ts long, full boolean, id string")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    got = warc.latest_before(df, "key", ["key", "ts", "full", "id"], "full", "id").where("not full").collect()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert {r.id: r.before for r in got} == brute_before(rows)
