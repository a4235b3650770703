import comparing
import duckdb
from pyspark.sql import functions as F

from tillwise.llm import hostrep, registry, sql

SF_DIR = "/root/testdata/sf0.001"


def judged(spark, urls, outcomes=(), **more):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame(list(outcomes), "page_id long, good boolean")
    return {r.page_id: r for r in hostrep.judge(pages, labels, registry.RULES, **more).collect()}


def test_hosts_paths_and_rules(spark):
    cases = {
        "http://A.Example.COM/en/x?y#z": ("a.example.com", "/en/x", "example.com/en/", "block"),
        "https://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        "https://x.www.example.com/en/1": ("x.www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "x://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "http://example.com": ("example.com", "", None, "allow"),
        "http://com/": ("com", "/", "com/", "allow"),
        "http://a.net/es/": ("a.net", "/es/", "net/es/", "block"),
        "http://a.net/es": ("a.net", "/es", None, "allow"),
        "http://a.net?/es/": ("a.net", "", None, "allow"),
        "http://a.net#://b.net/fr/": ("a.net", "", None, "allow"),
        "a.net/es/": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "http://É.Net/fr/\nx": ("É.net", "/fr/\nx", "net/fr/", "block"),
        "://host/p": ("host", "/p", None, "allow"),
    }
    got = judged(spark, list(cases), least_good=0.4)
    assert {u: (got[i].host, got[i].path, got[i].rule, got[i].verdict) for i, u in enumerate(cases)} == cases


def test_hosts_shrink_to_their_domain(spark):
    urls, outcomes = [], []
    for host, pages, good in (("a.bad.org", 400, 40), ("b.bad.org", 300, 30), ("new.bad.org", 1, None), ("a.good.org", 400, 396), ("b.good.org", 200, 196), ("new.good.org", 1, None)):
        for k in range(pages):
            outcomes += [(len(urls), k < good)] if good is not None else []
            urls.append(f"http://{host}/{k}")
    got = {r.host: r for r in judged(spark, urls, outcomes).values()}
    assert [got[h].verdict for h in ("a.bad.org", "new.bad.org", "a.good.org", "new.good.org")] == ["block", "block", "allow", "allow"]
    assert got["new.bad.org"].bound < 0.4 < 0.8 < got["new.good.org"].bound < got["a.good.org"].bound < 0.99


def test_domains_of_hosts(spark):
    hosts = {"a.b.example.com": ("example.com", "com"), "x.co.uk": ("x.co.uk", "co.uk"), "a.x.co.uk": ("x.co.uk", "co.uk"), "co.uk": ("co.uk", "uk"), "localhost": ("localhost", "localhost"), "10.0.0.1": ("10.0.0.1", "10.0.0.1"), "": ("", "")}
    rows = spark.createDataFrame([(h,) for h in hosts], "host string")
    domain, suffix = hostrep._levels(F.col("host"))
    assert {r[0]: (r[1], r[2]) for r in rows.select("host", domain, suffix).collect()} == hosts


def test_same_as_sql(spark):
    connection = duckdb.connect()
    for table in ("pages", "labels"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    mine = registry.op10_host_reputation(spark, SF_DIR).toPandas()
    assert comparing.differences(mine, connection.execute(sql.HOST_REPUTATION).df()) == []


def test_messy_rows(spark):
    pages = spark.createDataFrame([(None, "http://a.org/", "x"), (1, None, "x"), (1, None, "x"), (2, "http://a.org/" + "p" * 100_000, "x")], "page_id long, url string, host string")
    outcomes = spark.createDataFrame([(2, True), (2, None), (2, False), (None, True), (77, True)], "page_id long, good boolean")
    got = hostrep.judge(pages, outcomes, registry.RULES).collect()
    assert len(got) == 4 and {r.verdict for r in got} <= {"allow", "block"}
    assert hostrep.judge(pages.filter("false"), outcomes, registry.RULES).count() == 0
    assert hostrep.judge(pages, outcomes.filter("false"), []).count() == 4
