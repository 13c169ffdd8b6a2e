"""Verdicts do not depend on the number of seeds, nor end some hops away."""

from wayloom.llm import link_trust


def verdicts(spark, pages):
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    return {r.host: r.verdict for r in link_trust.filter_urls(df).collect()}


def linked(host, to):
    return (0, f"http://{host}/q", "".join(f'<a href="http://{t}/">' for t in to))


def test_hosts_many_hops_from_a_blocked_page(spark):
    chain = [linked(f"h{k}.io", [f"h{k + 1}.io"]) for k in range(14)] + [linked("h14.io", ["bad.org"])]
    got = verdicts(spark, chain + [(1, "http://bad.org/es/1", "")])
    assert all(got[f"h{k}.io"] == "block" for k in range(15))


def test_scores_of_a_large_graph_are_compared_as_a_ratio(spark):
    edges = spark.createDataFrame([("far.io", "mid.io", 1.0), ("mid.io", "bad.org", 1.0)], "src string, dst string, w double")
    seeds = spark.createDataFrame([(1, "bad.org", 1e-13), (1, "other.org", 1.0 - 1e-13), (0, "good.net", 1.0)], "walk int, host string, share double")
    got = {r.host: r for r in link_trust.host_scores(edges, seeds).collect()}
    assert 0 < got["far.io"].distrust < 1e-13 and got["far.io"].trust == 0


def test_a_faint_seed_still_blocks(spark, monkeypatch):
    scores = link_trust.host_scores
    faint = lambda edges, seeds, *a: scores(edges, seeds.withColumn("share", seeds.share * 1e-12), *a)
    monkeypatch.setattr(link_trust, "host_scores", faint)
    got = verdicts(spark, [linked("far.io", ["mid.io"]), linked("mid.io", ["bad.org"]), (1, "http://bad.org/es/1", "")])
    assert got["far.io"] == got["mid.io"] == "block"
