"""Trust over host graphs with rings, hubs and long chains: the query, its SQL and a plain iteration."""

import random
from collections import Counter, defaultdict

import duckdb
import pytest

from bazaarlake.llm import url_filter
from bazaarlake.session import work_dir


def pages_of(edges, seeds):
    """One page per host that links to others or is ruled; ``seeds``: hosts that rules judge by their path."""
    out, n = [], 0
    links = defaultdict(list)
    for a, b in edges:
        links[a].append(b)
    for host in sorted({*links, *seeds, *(b for _, b in edges)}):
        n += 1
        path = seeds.get(host, "/x")
        html = "".join(f'<a href="https://{b}/p">x</a>' for b in links[host])
        out.append((n, f"http://{host}{path}", html))
    return out


def plain(edges, seeds, damping=0.85):
    """Verdict per host without a rule after many steps."""
    kind = {h: "trust" if p.startswith("/fr/") else "distrust" for h, p in seeds.items()}
    links = Counter((a, b) for a, b in edges if a != b)
    out, into = Counter(), Counter()
    for (a, b), n in links.items():
        out[a] += n
        into[b] += n
    own = {"trust": Counter(), "distrust": Counter()}
    for h, k in kind.items():
        own[k][h] += (1 - damping) / len(seeds)
    score = {k: Counter(v) for k, v in own.items()}
    for _ in range(400):
        new = {k: Counter(v) for k, v in own.items()}
        for (a, b), n in links.items():
            new["trust"][b] += damping * score["trust"][a] * n / out[a]
            new["distrust"][a] += damping * score["distrust"][b] * n / into[b]
        score = new
    return lambda h: "block" if score["distrust"][h] > score["trust"][h] * url_filter.RATIO else "allow"


def graphs():
    rng = random.Random(6)
    ring = [(f"h{i}.net", f"h{(i + 1) % 13}.net") for i in range(13)]
    yield "ring", [*ring, ("h5.net", "bad.com")], {"bad.com": "/de/1"}
    chain = [(f"c{i}.net", f"c{i + 1}.net") for i in range(30)]
    yield "chain", [*chain, ("c30.net", "bad.com"), ("good.com", "c10.net")], {"bad.com": "/de/1", "good.com": "/fr/1"}
    hub = [(f"s{i}.net", "hub.net") for i in range(40)] + [("hub.net", f"t{i}.net") for i in range(20)]
    yield "hub", [*hub, ("t3.net", "bad.com"), ("good.com", "hub.net"), ("good.com", "hub.net")], {"bad.com": "/de/1", "good.com": "/fr/1"}
    edges = [(f"r{rng.randrange(25)}.net", f"r{rng.randrange(25)}.net") for _ in range(60)]
    yield "random", [*edges, ("r3.net", "bad.com"), ("good.com", "r7.net"), ("good.com", "r1.net")], {"bad.com": "/de/1", "good.com": "/fr/1"}


@pytest.mark.parametrize("name, edges, seeds", list(graphs()), ids=lambda x: x if isinstance(x, str) else "")
def test_query_sql_and_iteration_agree(spark, name, edges, seeds):
    pages = pages_of(edges, seeds)
    folder = work_dir(spark, "graph")
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    df.write.parquet(f"{folder}/pages.parquet")
    got = {r["host"]: r["verdict"] for r in url_filter.op1_host_trust(spark, folder).collect()}
    want = plain(edges, seeds)
    assert got == {h: {"/de/1": "block", "/fr/1": "allow"}.get(seeds.get(h)) or want(h) for h in got}
    assert len(set(got.values())) == 2 or name == "ring"
    con = duckdb.connect()
    con.register("pages", df.toArrow())
    con.execute(f"CREATE TABLE found AS {url_filter.OP1_SQL}")
    assert dict(con.execute("SELECT host, verdict FROM found").fetchall()) == got
