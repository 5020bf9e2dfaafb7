from itertools import combinations

from pyspark.sql import functions as F

from conftest import SF01
from mdmspark.llm import url_rules as ur
from mdmspark.llm.queries import op6_url_rules

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "MapInArrow", "PythonMapInArrow", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin")


def parts(spark, urls):
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    host, path, query = ur.url_parts()
    return [tuple(r) for r in df.select(host, path, query).collect()]


def test_parts(spark):
    assert parts(spark, ["http://A.Org/x/y?a=b#c", "x://h?q=1/2#f?g", "h.org/a", None, "s://H#f", "a://b://c/d", "://"]) == [
        ("a.org", "/x/y", "a=b"), ("h", "", "q=1/2"), ("", "", ""), ("", "", ""), ("h", "", ""), ("b:", "//c/d", ""), ("", "", "")]


def test_fixed_rules(spark):
    cases = {"http://a.example.org/es/1": "example.org/es/", "http://example.org/en/12": "example.org/en/1", "http://example.org/en/2": "org/",
             "http://myexample.org/es/": "org/", "http://x.com/fr/": "com/fr/", "http://x.com/de/1": "com/de/", "http://x.com/de": None, "http://a.org": None, "http://x.net/": None}
    df = spark.createDataFrame([(u,) for u in cases], "url string")
    host, path, _ = ur.url_parts()
    got = {r.url: r.rule for r in df.select("url", ur.fixed_rule(host, path)["rule"].alias("rule")).collect()}
    assert got == cases


def test_every_token_is_read(spark):
    url = "http://" + ".".join(f"l{c}" for c in "abcdefgh") + "/" + "/".join(f"p{c}" for c in "abcdefgh") + "?" + "&".join(f"k{c}=1" for c in "hgfedcba")
    df = spark.createDataFrame([(url,), (None,), ("http://a..b/12/12/?=3&",)], "url string")
    got = [r[0] for r in df.select(ur.all_tokens(*ur.url_parts())).collect()]
    assert len(got[0]) == 24 and got[1] == [] and got[2] == ["h:a", "h:b", "p:0"]


def test_mined_rules_equal_enumeration(spark):
    rows = []
    for i in range(400):
        tokens = sorted({f"t{i % 7}", f"u{i % 3}", f"v{i % 2}", "all"})
        rows.append((tokens, i % 7 == 1 and i % 3 != 0 or i % 11 == 0))
    got = {tuple(r.tokens): (r.n_fit, r.n_block) for r in ur.mine_rules(spark.createDataFrame(rows, "tokens array<string>, bad boolean"), min_pages=4).collect()}
    counts = {}
    for tokens, bad in rows:
        for k in range(1, len(tokens) + 1):
            for c in combinations(tokens, k):
                n, b = counts.get(c, (0, 0))
                counts[c] = (n + 1, b + bad)
    share = sum(b for _, b in rows) / len(rows)
    out = lambda n, b: b >= n * share and (b - n * share) ** 2 >= 9 * n * share * (1 - share)
    assert got == {c: (n, b) for c, (n, b) in counts.items() if b >= 4 and 2 * b >= n and out(n, b)} and got


def test_matching_equals_a_look_at_every_rule(spark):
    sets = [sorted({f"t{i % 5}", f"u{i % 7}", "all"}) for i in range(100)] + [[]]
    rules = [["t1"], ["t2", "u3"], ["all", "u6"], ["other"], ["t4", "zzz"]]
    got = ur.matched_sets(spark.createDataFrame([(s,) for s in sets], "tokens array<string>"), spark.createDataFrame([(r, 1, 1) for r in rules], "tokens array<string>, n_fit long, n_block long"))
    assert {tuple(r.tokens) for r in got.collect()} == {tuple(s) for s in sets if any(set(r) <= set(s) for r in rules)}


def test_plan_is_native(spark):
    plan = op6_url_rules(spark, SF01)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in FORBIDDEN)


def test_awkward_rows(spark):
    pages = spark.createDataFrame([(1, "http://bad.net/x"), (1, "http://bad.net/x"), (2, None), (3, ""), (None, "http://bad.net/x"), (4, "http://good.info/" + "a/" * 50_000)], "page_id long, url string")
    pages = pages.withColumns({c: F.lit("x") for c in ("host", "path", "tokens", "rule", "bad", "hit", "fixed")})
    labels = spark.createDataFrame([(1, True, 1)] * 5 + [(4, False, 1), (2, None, 1), (None, True, 1)], "page_id long, bad boolean, tokens int")
    rows = ur.judge_urls(pages, labels, min_pages=2, min_deviations=0).collect()  # nearly all labels are bad here
    assert sorted((r.page_id or 0, r.verdict) for r in rows) == [(0, "block"), (1, "block"), (1, "block"), (2, "allow"), (3, "allow"), (4, "allow")]
    assert {r.verdict for r in ur.judge_urls(pages, labels.limit(0)).collect()} == {"allow"}
    assert ur.judge_urls(pages.limit(0), labels).count() == 0


def test_every_token_of_a_url_can_block(spark):
    # The combination stands in the fourth of six path parts, a fifth host label or a fourth query name.
    deep = {"path": "http://a.b.net/p/q/r/{}/s/t", "host": "http://{}.d.c.b.a.net/p", "query": "http://a.b.net/p?a=1&b=2&c=3&{}=4"}
    for name, form in deep.items():
        urls = [form.format(x) for x in ("spam", "fine", "good")]
        pages = spark.createDataFrame([(i, urls[i % 3]) for i in range(30)], "page_id long, url string")
        labels = spark.createDataFrame([(i, i % 3 == 0) for i in range(27)], "page_id long, bad boolean")
        got = {(r.page_id % 3, r.verdict) for r in ur.judge_urls(pages, labels).collect()}
        assert got == {(0, "block"), (1, "allow"), (2, "allow")}, name


def test_long_urls_that_share_all_tokens_are_mined(spark):
    # 60 tokens that always occur together would make 2^60 combinations.
    url = "http://{}.net/" + "/".join("part" + chr(97 + i // 26) + chr(97 + i % 26) for i in range(60))
    pages = spark.createDataFrame([(i, url.format("ab"[i % 2])) for i in range(40)] + [(99, "http://a.net/other"), (98, "http://b.net/other")], "page_id long, url string")
    labels = spark.createDataFrame([(i, i % 2 == 0) for i in range(40)] + [(98, False)], "page_id long, bad boolean")
    got = {r.page_id: r.verdict for r in ur.judge_urls(pages, labels, min_confidence=0.6).collect()}
    assert got == {i: "block" if i % 2 == 0 else "allow" for i in range(40)} | {99: "block", 98: "allow"}


def test_a_rule_does_not_depend_on_the_size_of_the_table(spark):
    # 40 pages of one host, all bad, among few and among many good pages.
    for n in (2_000, 30_000):
        good = spark.range(n).select((F.col("id") + 1000).alias("page_id"), F.concat(F.lit("http://site"), F.col("id") % 50, F.lit(".net/page/"), F.col("id")).alias("url"))
        bad = spark.range(40).select(F.col("id").alias("page_id"), F.concat(F.lit("http://spam.biz/buy/"), F.col("id")).alias("url"))
        pages = good.unionByName(bad)
        labels = pages.select("page_id", (F.col("page_id") < 40).alias("bad"))
        blocked = {r.page_id for r in ur.judge_urls(pages, labels).where("verdict = 'block'").collect()}
        assert blocked == set(range(40)), n


def test_chance_is_no_rule(spark):
    # Half of all pages are bad, whatever their url: eight of twelve prove nothing, twenty of twenty do.
    rows = [(["all", f"x{i % 30}"], i % 2 == 0) for i in range(300)] + [(["all", "some"], i < 8) for i in range(12)] + [(["all", "sure"], True)] * 20
    got = {tuple(r.tokens) for r in ur.mine_rules(spark.createDataFrame(rows, "tokens array<string>, bad boolean")).collect()}
    assert ("sure",) in got and ("some",) not in got and ("all",) not in got


def test_deep_urls_agree_with_duckdb(spark, tmp_path):
    import duckdb

    from mdmspark.llm.queries import ORACLE

    deep = "http://{}.b.c.d.e.f.g.net/a/b/c/{}/e/f/g/h?k=1&l=1&m=1&n=1&o=1&p=1&{}=1&r=1"
    urls = [deep.format("xx" if i % 4 == 0 else "aa", "yy" if i % 5 == 0 else "bb", "zz" if i % 3 == 0 else "cc") for i in range(240)]
    spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame([(i, 0 if i % 4 == 0 and i % 3 == 0 or i % 5 == 0 and i % 2 == 0 else 1, 0) for i in range(200)], "doc_id long, quality int, toxic int").coalesce(1).write.parquet(f"{tmp_path}/labels.parquet")
    # DuckDB enumerates subsets, so all but the tokens that tell urls apart are taken off its copy.
    con = duckdb.connect()
    con.execute(f"create view labels as select * from read_parquet('{tmp_path}/labels.parquet/*.parquet')")
    con.execute(f"""create view pages as select page_id, regexp_replace(regexp_replace(url, '[.]b[.]c[.]d[.]e[.]f[.]g[.]net/a/b/c', '.net'), '/e/f/g/h.k=1&l=1&m=1&n=1&o=1&p=1&', '?') as url
      from read_parquet('{tmp_path}/pages.parquet/*.parquet')""")
    wanted = {r[0]: r[4] for r in con.execute(ORACLE["op6_url_rules"]).fetchall()}
    got = {r.page_id: r.verdict for r in op6_url_rules(spark, str(tmp_path)).collect()}
    assert got == wanted and set(got.values()) == {"allow", "block"}
