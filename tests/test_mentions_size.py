"""The mention search works on the distinct runs of all texts."""

import pytest

from docgraph.operators import link
from docgraph.plans import storage


@pytest.mark.parametrize("short", ["grid", "grid co", "x"])
def test_pieces_do_not_grow_with_repeated_runs(spark, monkeypatch, short):
    sizes, real = [], storage.stored

    def stored(df, name):
        out = real(df, name)
        if name == "met":
            sizes.append(out.count())
        return out

    monkeypatch.setattr(storage, "stored", stored)
    aliases = spark.createDataFrame([(1, short), (2, "of the grid code x")], "e long, alias string")
    for n in (10, 200):
        docs = spark.createDataFrame([(i, "see the\ngrid code x and mygrid") for i in range(n)], "id long, text string")
        hits = link.mentions(docs, "id", "text", aliases, "e").collect()
        assert len(hits) == n and {r.e for r in hits} == {1}
    assert len(sizes) == 2 and sizes[0] == sizes[1]


def test_blanks_and_line_ends_in_aliases(spark):
    texts = ["a  b", "a b", "a\nb", "xa by", "", None, " ", "c a\n b d"]
    alias = [" ", "a b", "a  b", "a\nb", "\n", "c a\n b d", " b", "a "]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    aliases = spark.createDataFrame(list(enumerate(alias)), "e long, alias string")
    got = {(r.id, r.e, r.pos, r.evidence_count) for r in link.mentions(docs, "id", "text", aliases, "e").collect()}
    assert got == {(i, e, t.index(a) + 1, t.count(a)) for i, t in enumerate(texts) for e, a in enumerate(alias) if t and a in t}
    seen = {(r.id, r.e) for r in link.present(docs, "id", "text", aliases, "e").collect()}
    assert seen == {(i, e) for i, e, _, _ in got}
