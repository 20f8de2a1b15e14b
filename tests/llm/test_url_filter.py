from __future__ import annotations

import random

from helpers import CLASHING
from pyspark.sql import functions as F

from gradewell.llm import url_filter

RULES = "verdict string, host string, path string"


def judged(spark, urls, rules, **options):
    pages = spark.createDataFrame([(k, u) for k, u in enumerate(urls)], "page_id bigint, url string")
    found = url_filter.judge(pages, spark.createDataFrame(rules, RULES), **options)
    return [tuple(r) for r in found.orderBy("page_id").select("host", "path", "rule", "verdict").collect()]


def test_parts_and_longest_rule(spark):
    rules = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("block", "net", "/fr"), (None, "x", "/"), ("block", None, "/")]
    urls = ["HTTP://A.Example.COM/en/x?y#z", "https://com/", "http://net/french", "http://com?x", "nothing", None, "",
            "http://acom/", "x://é.Example.com/en/\nz"]
    assert judged(spark, urls, rules) == [
        ("a.example.com", "/en/x", "example.com/en/", "block"),
        ("com", "/", "com/", "allow"),
        ("net", "/french", "net/fr", "block"),
        ("com", "", None, "allow"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("acom", "/", None, "allow"),
        ("é.example.com", "/en/\nz", "example.com/en/", "block"),
    ]


def brute_force(host, path, rules):
    fits = [(len(h + p), len(h), v, h + p) for v, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (max(fits)[3], max(fits)[2]) if fits else (None, "allow")


def test_random_list_with_a_filter_far_too_small(spark):
    """One block for hundreds of entries lets everything pass; the exact join has to remove it."""
    draw = random.Random(3)
    name = lambda: "".join(draw.choices("abc", k=draw.randint(1, 2)))
    rules = list({(h, p): (draw.choice(["allow", "block"]), h, p) for h, p in (
        (".".join(name() for _ in range(draw.randint(1, 3))), "/" + "".join(draw.choices("ab/", k=draw.randint(0, 3))))
        for _ in range(300))}.values())
    parts = [(".".join(name() for _ in range(draw.randint(1, 4))), "/" + "".join(draw.choices("ab/", k=draw.randint(0, 5))))
             for _ in range(400)]
    urls = [f"http://{h}{p}" for h, p in parts]
    expected = [(h, p, *brute_force(h, p, rules)) for h, p in parts]
    assert judged(spark, urls, rules, max_filter_bytes=32) == expected
    assert judged(spark, urls, rules) == expected


def test_empty_tables_repeats_and_clashing_names(spark):
    assert judged(spark, ["http://a.b/"], []) == [("a.b", "/", None, "allow")]
    rules = spark.createDataFrame([("block", "b", "/"), ("block", "b", "/")], RULES)
    pages = spark.createDataFrame([(1, "http://a.b/")] * 3 + [(None, None)], "page_id bigint, url string")
    odd = pages.select("*", *(F.lit(v).alias(n) for n, v in CLASHING.items()))
    found = url_filter.judge(odd, rules).collect()
    assert sorted((r.host, r.verdict, r["a.b"], r.row) for r in found) == [("", "allow", 14, 1)] + [("a.b", "block", 14, 1)] * 3
    assert url_filter.judge(odd.limit(0), rules).count() == 0


def test_no_python_in_the_plan(spark, small_folder):
    from gradewell.llm.queries import QUERIES

    for name in ("op1_url_filter", "op6_mix_sources", "op9_quality_rules"):
        plan = QUERIES[name](spark, small_folder)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
