"""Graph queries follow every relation from every document."""

from docgraph.catalog import QUERIES

PATH = "/root/testdata/sf0.001"


def targets(spark):
    """Every document's own edge, whatever its relation."""
    ids = [r.doc_id for r in spark.read.parquet(f"{PATH}/documents.parquet").select("doc_id").collect()]
    return {i: i + 1000000000 if i % 97 == 0 else i // 3 for i in ids if i > 0}


def test_chain_lists_all_that_every_document_leads_to(spark):
    up, want = targets(spark), {}
    for src in up:
        dst, depth = up.get(src), 1
        while dst is not None:
            want[src, dst] = depth
            dst, depth = up.get(dst), depth + 1
    got = {(r.src, r.dst): r.depth for r in QUERIES["graph_chain"](spark, PATH).collect()}
    assert got == want and {src for src, _ in got} == set(up)


def test_lineage_follows_every_relation(spark):
    up, want = targets(spark), {}
    for node in up:
        root, depth = up[node], 1
        while root in up:
            root, depth = up[root], depth + 1
        want[node] = root, depth, False
    got = {r.node: (r.root, r.depth, r.cyclic) for r in QUERIES["graph_lineage"](spark, PATH).collect()}
    assert got == want
