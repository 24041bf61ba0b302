"""Queries with a SQL statement, on the small tables and on tricky rows."""

import random

import duckdb
import pytest

import oracle_check
from conftest import SMALL
from latewatch.llm import exact_dedup, mixing, token_rollup, url_rules
from latewatch.llm.queries import ORACLES, QUERIES
from tricky_rows import marks, no_docs, tricky  # noqa: F401  the fixtures


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_statement(spark, name):
    assert oracle_check.compare(QUERIES[name](spark, SMALL), oracle_check.connect(SMALL), ORACLES[name]) is None


@pytest.mark.parametrize("kind", ["tricky", "no_docs"])
def test_documents_equal_statements(spark, kind, request, marks, tmp_path):
    docs = request.getfixturevalue(kind)
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    con.register("labels", marks.toArrow())
    assert oracle_check.compare(exact_dedup.judge_copies(docs), con, exact_dedup.ORACLE) is None
    assert oracle_check.compare(exact_dedup.judge_copies(docs, support=0.3), con, exact_dedup.ORACLE) is None
    assert oracle_check.compare(mixing.mix(docs), con, mixing.ORACLE) is None
    assert oracle_check.compare(token_rollup.corpus_rollup(spark, docs, marks, str(tmp_path)), con, token_rollup.ORACLE) is None


def test_urls_equal_statement(spark):
    urls = [
        None, "", "no scheme", "http://", "https://EXAMPLE.com/en/x", "http://www.example.com/en/1", "http://a.www.Example.com/en/",
        "http://notexample.com/en/1", "http://example.com/EN/1", "http://example.com", "http://x.net/es/", "http://net/es/", "x://y.net/especial",
        "http://x.net/fr/?q=/es/", "http://x.net?/es/", "http://x.net#/fr/", "a://b://c.com/en/", "http://spam-farm.org/", "http://sub.spam-farm.com/x",
        "http://x.org/login", "http://x.org/logins", "http://cheap-pills.org/casino/", "http://" + "a." * 3000 + "com/", "http://x.org/\nnet/es/",
        "http://click-bait-news.org/", "http://[::1]:80/com/", "http://\u212aiwi.com/en/", "http://x.org/click-bait-7/",
    ]
    pages = spark.createDataFrame([(k if k else None, u) for k, u in enumerate(urls + urls[:5])], "page_id long, url string")
    pages = pages.selectExpr("*", "'x' AS host", "'y' AS rule", "'z' AS subject")
    con = duckdb.connect()
    con.register("pages", pages.toArrow())
    assert oracle_check.compare(url_rules.judge_urls(pages), con, url_rules.oracle()) is None
    assert url_rules.judge_urls(pages.limit(0)).count() == 0


def test_a_hundred_thousand_rules(spark):
    """Against every rule tried by comparing strings: hosts and paths of rules are drawn from few parts, so that many fit."""
    rng = random.Random(12)
    names = {f"{rng.choice('abcdefgh')}{rng.randrange(9000)}.{rng.choice(['com', 'net'])}/{rng.choice(['', 'en/', 'es/x/'])}" for _ in range(140_000)}
    rules = [(n, rng.choice(["allow", "block"])) for n in sorted(names)[:99_000]] + [(f"t{k}.org/", "block") for k in range(1000)]
    urls = [f"http://{rng.choice(['', 'www.', 'w.w.'])}{rng.choice('abcdefgh')}{rng.randrange(9000)}.{rng.choice(['com', 'net'])}/{rng.choice(['', 'en/q', 'es/x/'])}"
            for _ in range(300)] + [f"https://t{k}.org/" for k in range(995, 1005)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    judged = url_rules.judge_urls(pages, tuple(url_rules.host_rule(*r) for r in rules))
    expected = {}
    for k, url in enumerate(urls):
        host, path = url.split("://")[1].split("/", 1)
        fits = [(len(n), n, v) for n, v in rules if (host == n.split("/")[0] or host.endswith("." + n.split("/")[0])) and ("/" + path).startswith("/" + n.split("/", 1)[1])]
        expected[k] = max(fits)[1:] if fits else (None, "allow")
    assert {r["page_id"]: (r["rule"], r["verdict"]) for r in judged.collect()} == expected
    assert sum(v[0] is not None for v in expected.values()) > 100


def test_index_takes_the_rarest_token():
    index = url_rules.index_rules(url_rules.BASE_RULES)
    assert {t: [r.name for r in held] for t, held in index.items()} == {
        "com": ["com/"], "example": ["example.com/en/"], "www": ["www.example.com/en/"], "es": ["net/es/"], "fr": ["net/fr/"],
    }
    assert url_rules.host_rule("a.org/fr", "block").tokens == ("a", "org")


def test_native_queries_have_no_python(spark):
    for name in ("op1_url_filters", "op3_exact_dedup", "op7_mixing"):
        plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_frequent_digests_are_found(spark):
    docs = spark.range(2000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'hot', cast(id AS string)) AS text")
    winners = exact_dedup.frequent_winners(exact_dedup.digest_rows(docs), 0.1).filter("group_size > 1").collect()
    assert [(w["group_size"], w["winner"]["order"]["id"]) for w in winners] == [(667, 0)]


def test_deduplicate_keeps_one_row_of_each_text(tricky):
    kept = exact_dedup.deduplicate(tricky)
    assert kept.columns == tricky.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == [
        (False, k) for k in (1, 3, 4, 6, 7, 8, 9, 9, 10, 11, 12, 13)
    ]


def test_targets_stop_at_twice_the_source(spark):
    rows = [("a", 1000), ("b", 10), ("c", 100), ("d", 50), (None, 400)]
    out = mixing.source_targets(spark.createDataFrame([(s, n, 1) for s, n in rows], "source string, source_size long, documents long"))
    got = {r["source"]: (r["target"], r["source_size"]) for r in out.collect()}
    # By hand: shares are dealt again until no target is above twice its source.
    left, size, weight = 1.5 * 1560, dict(rows), {"a": 5, "b": 2, "c": 1, "d": 5, None: 2}
    full = set()
    while True:
        level = left / sum(w for s, w in weight.items() if s not in full)
        over = {s for s in weight if s not in full and level * weight[s] > 2 * size[s]}
        if not over:
            break
        full |= over
        left -= sum(2 * size[s] for s in over)
    for s in weight:
        assert got[s][0] == pytest.approx(2 * size[s] if s in full else level * weight[s])


def test_mix_comes_near_its_targets_and_is_repeatable(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    first = {(r["doc_id"], r["taken"]) for r in mixing.mix(docs).collect()}
    second = mixing.mix(docs.repartition(5), rows_per_shard=20_000).collect()
    assert first == {(r["doc_id"], r["taken"]) for r in second}
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in second)
    by_source = {}
    for r in mixing.mix(docs, rows_per_shard=3).collect():
        target, taken = by_source.get(r["source"], (r["target"], 0))
        by_source[r["source"]] = (target, taken + r["taken"])
    for target, taken in by_source.values():
        assert abs(taken - target) <= 0.02 * target + 6 * mixing.BLOCK


def test_mixed_documents_are_whole(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    copies = mixed.groupBy(*docs.columns).count()
    assert copies.filter("count > 2").count() == 0
    assert copies.join(docs, docs.columns, "left_anti").count() == 0


def test_rollup_is_idempotent_and_recovers(spark, tmp_path):
    rollup = token_rollup.Rollup(spark, str(tmp_path))
    one = spark.createDataFrame([("s", "en", "v1", 5), (None, "en", "v1", None)], "source string, lang string, tokenizer string, tokens long")
    assert rollup.totals().count() == 0
    assert rollup.commit("b1", token_rollup.inserts(one)) and not rollup.commit("b1", token_rollup.inserts(one))
    (tmp_path / "batch-b2").mkdir()
    (tmp_path / "batch-b2" / "part-0.parquet").write_bytes(b"half")  # its writer was lost
    expected = {("s", "en", "v1", 1, 5), (None, "en", "v1", 1, 0)}
    assert {tuple(r) for r in rollup.totals().collect()} == expected
    rollup.compact()
    assert {tuple(r) for r in rollup.totals().collect()} == expected and rollup.committed() == {"b1"}
    assert not rollup.commit("b1", token_rollup.inserts(one))
    new = one.withColumn("tokens", one["tokens"] + 2)
    assert rollup.commit("b2", token_rollup.revisions(one, new))
    assert ("s", "en", "v1", 1, 7) in {tuple(r) for r in rollup.totals().collect()}
    assert rollup.commit("b3", token_rollup.deletes(new))
    assert rollup.commit("b4", token_rollup.inserts(one.limit(0)))
    rollup.compact()
    assert rollup.totals().count() == 0 and rollup.committed() == {"b1", "b2", "b3", "b4"}
