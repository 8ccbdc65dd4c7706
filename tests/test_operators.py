"""Operators on hand-written frames: nulls, ties, empty input, collisions, cycles, CJK text."""

import datetime as dt
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from docgraph.functions import fixed
from docgraph.operators import (agg, audit, backlog, check, cover, dedup, gate, graph, ident, link, lint, norm,
                                opinion, rank, rel, report, score, theme, version)
from docgraph.plans import storage


def frame(spark, schema, *data):
    return spark.createDataFrame(list(data), schema)


# -- identity ------------------------------------------------------------------------------

def test_ids(spark):
    df = frame(spark, "d date, i string, n string, t string",
               (dt.date(2024, 1, 5), "NDRC", "718", "x"), (None, "NEA", "", "x"), (None, None, None, "x"))
    a, b, c = [r[0] for r in df.select(ident.make_id(F.col("d"), F.col("i"), F.col("n"), F.col("t"))).collect()]
    assert a == "P_2024_NDRC_718"
    assert b.startswith("P_1900_NEA_") and len(b.split("_")[3]) == 8
    assert c.startswith("P_1900_OTHER") and c.split("_")[3] == b.split("_")[3]


def test_number_tail(spark):
    df = frame(spark, "n string", ("发改办能源〔2024〕718号",), ("",))
    assert [r[0] for r in df.select(ident.number_tail(F.col("n"))).collect()] == ["718", None]


def test_suffixes(spark):
    df = spark.range(30).select(F.col("id").alias("o"), F.when(F.col("id") == 29, "solo").otherwise("dup").alias("k"))
    out = {r.o: r.unique_id for r in ident.suffix(df, "k", "o").collect()}
    assert (out[0], out[25], out[26], out[28], out[29]) == ("dup_a", "dup_z", "dup_aa", "dup_ac", "solo")
    assert len(set(out.values())) == 30


def test_resolve(spark):
    docs = frame(spark, "id string, aliases array<string>", ("new", ["old", "new", "x"]), ("b", ["x"]))
    refs = frame(spark, "ref string", ("old",), ("new",), ("gone",), ("x",))
    got = {r.ref: (r.resolved, r.status) for r in ident.resolve(refs, "ref", docs, "id", "aliases").collect()}
    assert got == {"old": ("new", "moved"), "new": ("new", "current"), "gone": ("gone", "unknown"),
                   "x": ("x", "ambiguous")}


def test_recompute_keeps_an_audit_trail(spark):
    df = frame(spark, "id int, y int, a int, b int", (1, 1900, None, 2024), (2, 2020, 2020, 2024), (3, 5, None, None))
    out = ident.recompute(df, "y", {"first": (F.col("a"), 0.9), "second": (F.col("b"), 0.5)},
                          F.lit("2026-01-01").cast("timestamp")).orderBy("id").collect()
    assert [(r.y, r.y_fixed_from, r.y_fixed_method, r.y_fix_confidence) for r in out] == [
        (2024, 1900, "second", 0.5), (2020, None, None, None), (5, None, None, None)]


def test_history_and_latest(spark):
    df = frame(spark, "k string, ts date, id long", ("a", dt.date(2024, 1, 1), 1), ("a", dt.date(2024, 1, 1), 2),
               ("a", dt.date(2023, 5, 1), 3), ("b", dt.date(2024, 1, 1), 4))
    out = {r.id: (r.valid_to, r.live) for r in version.history(df, "k", "ts", "id").collect()}
    assert out == {3: (dt.date(2024, 1, 1), False), 1: (dt.date(2024, 1, 1), False), 2: (None, True), 4: (None, True)}
    assert {r.id for r in version.latest(df, "k", ["ts", "id"]).collect()} == {2, 4}


def test_ids_renamed_several_times(spark):
    """Chains, a rename taken back by a later one, a circle, repeated audit rows."""
    rows = [(f"a{i}", f"a{i + 1}", i) for i in range(20)] + [("b0", "b9", 1), ("b0", "b1", 2), ("c0", "c1", 1), ("c1", "c0", 2),
            ("d", "c0", 3), (None, "x", 1), ("y", None, 1), ("e", "e", 1), ("a3", "a4", 3)]
    paths = ident.renamed(frame(spark, "old string, new string, at int", *rows), "old", "new", "at")
    got = {r.former: (r.current, r.steps, r.status) for r in paths.collect()}
    assert got == {**{f"a{i}": ("a20", 20 - i, "moved") for i in range(20)}, "b0": ("b1", 1, "moved"),
                   **{c: (None, None, "cycle") for c in ("c0", "c1", "d")}}
    docs = frame(spark, "id string, aliases array<string>, n int", ("a0", ["a0", "old"], 1), ("a20", None, 2), ("b0", [], 3),
                 ("c0", ["z"], 4), (None, None, 5), ("q", ["q"], 6))
    out = {r.n: (r.id, r.aliases) for r in ident.with_former_ids(docs, "id", "aliases", paths).collect()}
    ways = sorted(f"a{i}" for i in range(21))
    assert out == {1: ("a20", sorted([*ways, "old"])), 2: ("a20", ways), 3: ("b1", ["b0", "b1"]), 4: ("c0", ["c0", "z"]),
                   5: (None, []), 6: ("q", ["q"])}


def test_recomputed_id_keeps_both_ids(spark):
    df = frame(spark, "id string, aliases array<string>, d string", ("P_1900_A_1", ["P_1900_A_1"], "2031"),
               ("P_2030_A_2", None, None), ("P_2030_A_3", ["x"], "2030"))
    new = F.when(F.col("d").isNotNull(), F.concat(F.lit("P_"), "d", F.substring("id", 7, 9)))
    out = ident.reidentify(df, "id", "aliases", new, "id_recompute_from_metadata", F.lit("2032-01-01").cast("timestamp"))
    got = {r.id: (r.aliases, r.id_fixed_from, r.id_fixed_method) for r in out.collect()}
    assert got == {"P_2031_A_1": (["P_1900_A_1", "P_2031_A_1"], "P_1900_A_1", "id_recompute_from_metadata"),
                   "P_2030_A_2": (["P_2030_A_2"], None, None), "P_2030_A_3": (["P_2030_A_3", "x"], None, None)}


# -- copies --------------------------------------------------------------------------------

def copies(texts, threshold=0.8):
    """Key to (least key of its group, similarity with the group's kept text)."""
    def runs(t):
        w = [x for x in "".join(c if c.isalnum() else " " for c in t.lower()).split()]
        return frozenset(" ".join(w[i:i + 3]) for i in range(max(len(w) - 2, 1)))
    sets = {i: runs(t) for i, t in enumerate(texts) if t is not None}
    first = {}
    for i, own in sets.items():
        first.setdefault(own, i)
    order = sorted(first.values(), key=lambda i: (hashlib.md5(str(i).encode()).hexdigest(), i))
    alike = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    kept = []
    for i in order:
        if all(alike(i, e) < threshold for e in kept):
            kept.append(i)
    groups = {}
    for i, own in sets.items():
        c = first[own]
        center = c if c in kept else next(e for e in kept if alike(c, e) >= threshold)
        groups.setdefault(center, []).append((i, alike(c, center)))
    return {i: (min(m)[0], round(x, 9)) for m in groups.values() for i, x in m if i != min(m)[0]}


def found(spark, texts, **options):
    df = frame(spark, "id long, text string", *enumerate(texts))
    return {r.id: (r.original, round(r.similarity, 9)) for r in dedup.near(df, "id", "text", **options).collect()}


@pytest.mark.parametrize("led", [0, 1, 4])
def test_near_copies_against_brute_force(spark, led):
    """Whatever the number of leader rounds."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.randrange(40, 120))]
        texts.append(" ".join(base))
        for _ in range(rng.randrange(0, 12)):
            copy = list(base)
            for _ in range(rng.randrange(0, 6)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    texts += ["short", "short", "", texts[0], None, "", None]
    got = found(spark, texts, led=led)
    assert got == copies(texts) and len(got) > 20


def test_near_copies_at_a_low_threshold(spark):
    """Pairs just above the threshold are found as surely as close ones, also in small buckets."""
    rng = random.Random(5)
    texts = []
    for i in range(60):
        base = [f"w{i}x{j}" for j in range(30)]
        texts.append(" ".join(base))
        texts.append(" ".join(base[:22] + [f"y{i}x{j}" for j in range(rng.randrange(3, 9))]))
    got = found(spark, texts, threshold=0.5)
    assert got == copies(texts, 0.5) and len(got) > 30


def test_near_copies_among_texts_of_one_template(spark):
    """Hundreds of texts share most runs without being copies; the few copies are still found."""
    rng = random.Random(11)
    body = " ".join(f"t{i}" for i in range(14))
    texts = [f"a{i} b{i} {body} c{i} d{i}" for i in range(250)]
    for i in range(0, 60, 3):
        texts.append(texts[i] + " tail")
    rng.shuffle(texts)
    got = found(spark, texts)
    assert got == copies(texts) and len(got) == 20


def test_near_copies_of_one_text(spark):
    base = " ".join(f"w{i}" for i in range(60))
    got = found(spark, [base if i % 2 else base + " tail" for i in range(300)])
    assert len(got) == 299 and {o for o, _ in got.values()} == {0}


def test_rolling_versions_fall_apart_in_few_rounds(spark, monkeypatch):
    """Each of 200 versions resembles only its neighbours, in the order of the keys."""
    words = [f"w{i}" for i in range(700)]
    texts = [" ".join(words[3 * i:3 * i + 60]) for i in range(200)]
    rounds, real = [], storage.cut
    monkeypatch.setattr(storage, "cut", lambda df: rounds.append(1) or real(df))
    got = found(spark, texts)
    assert got == copies(texts) and len(got) > 80
    assert len(rounds) <= 20


def test_rows_without_text_are_kept_and_no_copies(spark):
    df = frame(spark, "id long, text string", (1, None), (2, None), (3, "a"), (4, "a"))
    got = {r.id: (r.original, r.copies, r.is_copy) for r in dedup.exact(df, "id", F.col("text")).collect()}
    assert got == {1: (1, 1, False), 2: (2, 1, False), 3: (3, 2, False), 4: (3, 2, True)}


def test_no_copies(spark):
    df = frame(spark, "id long, text string", (1, "a b c d"), (2, "e f g h"))
    assert dedup.near(df, "id", "text").count() == 0
    assert dedup.exact(df, "id", F.col("text")).filter("is_copy").count() == 0


# -- links ---------------------------------------------------------------------------------

def test_dictionary_tags_cjk_short_and_long_aliases(spark):
    docs = frame(spark, "id long, text string", (1, "关于车网互动V2G的通知"), (2, "储能"), (3, "the grid code of the land, V2G"),
                 (4, "athe grid code of theb"), (5, None))
    aliases = frame(spark, "e string, alias string", ("v2g", "车网互动"), ("v2g", "V2G"), ("es", "储能"),
                    ("gc", "the grid code of the"), ("one", "x"))
    hits = link.mentions(docs, "id", "text", aliases, "e")
    assert {(r.id, r.e, r.alias) for r in hits.collect()} == {
        (1, "v2g", "车网互动"), (1, "v2g", "V2G"), (2, "es", "储能"), (3, "v2g", "V2G"),
        (3, "gc", "the grid code of the"), (4, "gc", "the grid code of the")}
    tags = link.tags(hits, "id", "e")
    assert {(r.id, r.primary, r.n_themes) for r in link.primary(tags, "id", "e").collect()} == {
        (1, "v2g", 1), (2, "es", 1), (3, "gc", 2), (4, "gc", 1)}


def test_aliases_of_one_character(spark):
    docs = frame(spark, "id long, text string", (1, "Ø"), (2, "xØyØ"), (3, "o x"), (4, ""), (5, None), (6, "a 😀 b"))
    aliases = frame(spark, "e string, alias string", ("o", "Ø"), ("s", "😀"), ("x", "xØ"), ("none", ""))
    got = link.mentions(docs, "id", "text", aliases, "e").collect()
    assert {(r.id, r.e, r.pos, r.evidence_count) for r in got} == {
        (1, "o", 1, 1), (2, "o", 2, 2), (2, "x", 1, 1), (6, "s", 3, 1)}
    assert len(got) == 4


def test_every_occurrence_against_brute_force(spark):
    """Short, long, overlapping, quoted and CJK aliases; repeated rows and null keys."""
    rng = random.Random(9)
    texts = [" ".join(rng.choice(["ab", "aba", "c.d", "車網", "\\E", "the", "grid"]) for _ in range(rng.randrange(0, 40)))
             for _ in range(60)] + [None, "", "aaaa"]
    alias = ["ab", "aba", "aa", "c.d", "車網", "\\E", "the grid the", "b the grid aba c", "grid 車網", "a", "網 the", "nowhere to be found"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (1, texts[1])]
    docs = frame(spark, "id long, text string", *rows)
    aliases = frame(spark, "e long, alias string", *enumerate(alias), (100, "ab"), (0, "ab"))
    got = link.occurrences(link.mentions(docs, "id", "text", aliases, "e"), "id", "e").collect()
    want = []
    for i, t in rows:
        for e, a in [*enumerate(alias), (100, "ab")]:
            at, nth = (t or "").find(a), 0
            while at >= 0:
                nth += 1
                want.append((i, e, a, nth, at + 1, t[max(0, at - 30):at + len(a) + 30]))
                at = t.find(a, at + len(a))
    assert sorted((tuple(r)[:6] for r in got), key=str) == sorted(want, key=str) and len(want) > 500


def test_anchors_are_the_rarest_tokens(spark):
    """Of an alias's words the one of fewest documents brings texts and alias together."""
    docs = frame(spark, "id long, text string", *[(i, f"common words stand here {'rare' if i == 7 else 'too'} and more") for i in range(40)])
    aliases = frame(spark, "e long, alias string", (1, "words stand here rare and"), (2, "common words stand never and"))
    wanted = link._candidates(aliases)
    assert {r._token for r in wanted.filter("e = 1").collect()} == {"stand", "here", "rare"}
    hits = link.mentions(docs, "id", "text", aliases, "e").collect()
    assert [(r.id, r.e, r.pos) for r in hits] == [(7, 1, 8)]


def test_a_repeal_at_the_second_occurrence(spark):
    text = "see rule 7 of the land. " + "x " * 900 + "hereby rule 7 of the land 废止"
    docs = frame(spark, "id long, text string", (1, text), (2, "废止 " + "y " * 500 + "rule 7 of the land"))
    hits = link.mentions(docs, "id", "text", frame(spark, "m string, alias string", ("r7", "rule 7 of the land")), "m")
    refs = rel.references(hits, "id", "m", frame(spark, "m string, d long", ("r7", 70)), "d")
    got = {r.id: (r.repeals, r.opening, r.evidence_count) for r in refs.collect()}
    assert got == {1: (True, True, 2), 2: (False, False, 1)}
    assert [(r.id, r.d) for r in rel.supersedes(refs).collect()] == [(1, 70)]


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_fuzzy_titles_against_brute_force(spark, distance):
    rng = random.Random(5)
    titles = sorted({"".join(rng.choice("ab車網") for _ in range(rng.randrange(1, 9))) for _ in range(120)})
    left, right = titles[::2] + ["", None], titles[1::2] + [titles[0], None, ""]
    got = {r.title: (r.distance, r.match) for r in link.fuzzy_title(
        frame(spark, "title string", *[(t,) for t in left]),
        frame(spark, "title string", *[(t,) for t in right]), distance).collect()}

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    want = {}
    for a in left:
        if a is None:
            continue
        near = [(edits(a, b), b.encode()) for b in right if b is not None and a != b and edits(a, b) <= distance]
        if near:
            d, b = min(near)
            want[a] = (d, b.decode())
    assert got == want


def test_cascade_takes_the_first_stage(spark):
    comments = frame(spark, "id long", (1,), (2,), (3,))
    table = lambda *rows: (lambda rest: rest.join(frame(spark, "id long, target string", *rows), "id"))
    out = link.cascade(comments, "id", {"number": table((1, "b"), (1, "a")), "title": table((1, "z"), (2, "t"))})
    assert {tuple(r) for r in out.collect()} == {(1, "a", "number"), (2, "t", "title"), (3, None, "none")}


def test_titles_of_the_cascade_exact_then_close(spark):
    known = frame(spark, "title string, id long", ("harbour fees 2031", 7), ("harbour fees 2031", 4), ("rail fees 2030", 5), (None, 9))
    asked = frame(spark, "k long, title string", (1, "harbour fees 2031"), (2, "harbour fee 2031"), (3, "rail fees 2031"), (4, "other"),
                  (5, None), (6, "rail fees 2031"))
    out = link.cascade(asked, "k", {"exact": lambda r: link.by_title(r, "k", "title", known, "id"),
                                    "fuzzy": lambda r: link.by_title(r, "k", "title", known, "id", 2)})
    assert {tuple(r) for r in out.collect()} == {(1, 4, "exact"), (2, 4, "fuzzy"), (3, 5, "fuzzy"), (6, 5, "fuzzy"),
                                                 (4, None, "none"), (5, None, "none")}


# -- relations -----------------------------------------------------------------------------

def test_same_month_is_parallel_and_never_an_origin(spark):
    docs = frame(spark, "id long, theme string, date date", (10, "t", dt.date(2024, 6, 20)), (11, "u", dt.date(2024, 6, 20)))
    sources = frame(spark, "id long, theme string, date date", (1, "t", dt.date(2023, 6, 21)), (2, "t", dt.date(2023, 12, 23)),
                    (3, "t", dt.date(2023, 12, 24)), (4, "t", dt.date(2024, 6, 1)), (5, "t", dt.date(2023, 6, 20)))
    got = {r.src: (r.origins, r.first_origin, r.last_origin, r.parallel)
           for r in rel.derives(docs, sources, "id", "theme", "date").collect()}
    assert got == {10: (2, 1, 2, 1), 11: (0, None, None, 0)}


def test_linkage_classes(spark):
    df = frame(spark, "l string", ("直接落地",), ("借鉴框架",), ("主题对应",), ("?",))
    assert [r.evidence_class for r in rel.linkage_class(df, "l").collect()] == ["直接落地", "补充细化", "同向部署", None]


def test_repeal_and_basis(spark):
    mentions = frame(spark, "s long, m string, pos long, snippet string, location string, evidence_count long",
                     (1, "a", 5, "根据一号", "opening", 1), (1, "a", 90, "同时废止一号", "body", 1),
                     (1, "b", 9, "根据二号", "opening", 1), (2, "a", 7, "根据一号", "body", 1), (2, "b", 8, None, "body", 1))
    mentions = mentions.withColumn("hits", F.array(F.struct("pos", "snippet", "location")))
    docs = frame(spark, "m string, d long", ("a", 7), ("b", 8))
    refs = rel.references(mentions, "s", "m", docs, "d")
    assert [(r.s, r.m) for r in rel.supersedes(refs).collect()] == [(1, "a")]
    verdicts = frame(spark, "s long, m string, semantic string", (1, "a", "basis"), (9, "a", "basis"))
    got = rel.cites_basis(refs, verdicts, "s", "m").collect()
    assert sorted((r.s, r.m, r.semantic or "") for r in got) == [(1, "a", "basis"), (1, "b", "")]


def test_conflicts_with_the_nearest_other_stance(spark):
    day = dt.date(2024, 1, 1)
    docs = frame(spark, "id long, t string, d date, s int, c string", (1, "t", day, 5, "A"), (2, "t", day, 5, "B"),
                 (3, "t", day, 5, "B"), (4, "t", day, 5, None), (5, "t", day, 5, "B"), (6, "t", day, 3, "A"),
                 (7, "t", day, 5, "C"), (8, "u", day, 5, "A"))
    got = {r.src: (r.dst, r.dst_stance, r.earlier) for r in rel.conflict_pairs(docs, "id", "t", "d", "s", "c").collect()}
    assert got == {2: (1, "A", 1), 3: (1, "A", 1), 5: (1, "A", 1), 7: (5, "B", 4)}


# -- graph ---------------------------------------------------------------------------------

EDGES = [("a", "b", "iterates"), ("b", "c", "iterates"), ("c", "a", "iterates"), ("d", "a", "references"),
         ("x", "x", "extends"), ("d", None, "derives_from")]


def test_chain_ends_on_cycles(spark):
    edges = frame(spark, "src string, dst string, rel string", *EDGES)
    starts = frame(spark, "src string", ("a",), ("d",), ("d",), ("nowhere",), (None,))
    got = {(r.src, r.dst): r.depth for r in graph.chain(edges, starts, None).collect()}
    assert got == {("a", "b"): 1, ("a", "c"): 2, ("d", "a"): 1, ("d", "b"): 2, ("d", "c"): 3}
    two = graph.chain(edges, starts, None, max_depth=2)
    assert {(r.src, r.dst) for r in two.collect()} == set(got) - {("d", "c")}


@pytest.mark.parametrize("seed", range(3))
def test_chains_against_breadth_first_search(spark, seed):
    """Branches, joins, cycles, other relations and repeated edges."""
    rng = random.Random(seed)
    rows = [(rng.randrange(40), rng.randrange(40), rng.choice(["iterates", "supersedes", "aligns_with"])) for _ in range(60)]
    rows += [(100 + i, 101 + i, "iterates") for i in range(37)]
    edges = frame(spark, "src long, dst long, rel string", *rows, *rows[:5])
    starts = [0, 1, 2, 3, 100, 120]
    want = {}
    for s in starts:
        seen, layer, depth = {s}, {s}, 0
        while layer:
            depth += 1
            layer = {d for a, d, r in rows if a in layer and r != "aligns_with"} - seen
            want.update({(s, d): depth for d in layer})
            seen |= layer
    got = graph.chain(edges, frame(spark, "src long", *[(s,) for s in starts]))
    assert {(r.src, r.dst): r.depth for r in got.collect()} == want
    ends = {d for a, d, r in rows if r != "aligns_with" and a != d}
    assert {r.src for r in graph.heads(edges).collect()} == {
        a for a, d, r in rows if r != "aligns_with" and a != d} - ends


def test_a_long_chain_has_a_row_per_node_and_few_rounds(spark, monkeypatch):
    rounds, real = [], storage.cut
    monkeypatch.setattr(storage, "cut", lambda df: rounds.append(1) or real(df))
    edges = frame(spark, "src long, dst long, rel string", *[(i, i - 1, "iterates") for i in range(1, 301)])
    got = graph.chain(edges, graph.heads(edges)).collect()
    assert {(r.src, r.dst, r.depth) for r in got} == {(300, i, 300 - i) for i in range(300)} and len(got) == 300
    assert len(rounds) <= 22


def test_lineage_of_long_chains_and_cycles(spark):
    chain = [(i, i - 1, "iterates") for i in range(1, 38)] + [(100, 101, "iterates"), (101, 102, "supersedes"),
                                                              (102, 100, "iterates"), (103, 100, "iterates"), (37, 104, "extends")]
    rows = graph.lineage(frame(spark, "src long, dst long, rel string", *chain)).collect()
    assert {r.node: (r.root, r.depth, r.cyclic) for r in rows} == {
        **{i: (0, i, False) for i in range(1, 38)}, **{i: (None, None, True) for i in (100, 101, 102, 103)}}


def test_reverse_index_mirrors(spark):
    edges = frame(spark, "src string, dst string, rel string", *EDGES)
    views = graph.reverse(edges)
    assert graph.mirror(views.filter("other is not null")).count() == 0
    sides = {r.direction: r.n for r in views.filter("other is not null").groupBy("direction").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    assert sides["in"] == sides["out"] == 5
    back = {v: k for k, v in fixed.REVERSE_NAMES.items()}
    twice = views.filter("direction = 'in'").select(
        F.col("other").alias("src"), F.col("node").alias("dst"), graph.renamed(F.col("section"), back).alias("rel"))
    assert set(map(tuple, twice.collect())) == {e for e in EDGES if e[1]}
    broken = graph.mirror(views.filter("not (direction = 'in' and node = 'b') and other is not null"))
    assert [tuple(r) for r in broken.collect()] == [("a", "b", "iterates", -1)]


def test_isolated_and_orphans(spark):
    edges = frame(spark, "src string, dst string, rel string", *EDGES)
    nodes = frame(spark, "id string", ("a",), ("b",), ("z",), ("d",))
    assert [r.id for r in graph.isolated(nodes, "id", edges).collect()] == ["z"]
    lost = {(r.src, r.dst, r.missing_end) for r in lint.orphans(edges, nodes, "id").collect()}
    assert lost == {("c", "a", "src"), ("b", "c", "dst"), ("x", "x", "src"), ("x", "x", "dst"), ("d", None, "unresolved")}


# -- norm, lint, gates ---------------------------------------------------------------------

def test_confidence_and_enum(spark):
    df = frame(spark, "c string, t string", ("0.95", "核心政策"), ("Medium", "policy"), ("", "x"), (None, None))
    out = norm.enum(norm.confidence(df, "c", "n"), "t", fixed.DOCUMENT_TYPES, "kind", "other").collect()
    assert [(r.n, r.kind) for r in out] == [(0.95, "core_policy"), (0.7, "policy"), (None, "other"), (None, "other")]


def test_legacy_alias(spark):
    df = frame(spark, "fetched_via string, fetched_method string", ("", "a"), ("b", "c"), (None, "~"))
    out = norm.coalesce_alias(df, fixed.LEGACY_FIELDS)
    assert out.columns == ["fetched_via"] and [r[0] for r in out.collect()] == ["a", "b", None]


def test_fields_sections_required(spark):
    fields = frame(spark, "field string", ("title",), ("tags",), ("fetched_method",), ("zzz",))
    got = lint.field_whitelist(fields, fixed.ALLOWED_FIELDS, fixed.FORBIDDEN_FIELDS, list(fixed.LEGACY_FIELDS))
    assert [r.status for r in got.collect()] == ["allowed", "forbidden", "legacy", "unknown"]
    from docgraph.functions import text
    body = frame(spark, "b string", ("## 政策原文\n## 摘要\n",), ("## 政策原文\n",))
    assert [r.section for r in lint.body_sections(body, text.headings("b"), fixed.ALLOWED_SECTIONS).collect()] == ["摘要"]
    rows = frame(spark, "id int, date date, t string", (1, None, ""), (2, dt.date(2024, 1, 1), "x"))
    assert [(r.id, r.missing) for r in lint.required(rows, ["date", "t"]).collect()] == [(1, ["date", "t"])]


def test_id_years(spark):
    df = frame(spark, "id string, d date", ("P_1900_A_1", None), ("P_2030_A_1", dt.date(2030, 1, 1)),
               ("P_2024_A_1", dt.date(2023, 1, 1)), ("P_2024_A_2", dt.date(2024, 1, 1)), ("bad", None))
    got = {r.id: r.problem for r in lint.id_year(df, "id", "d", 2026).collect()}
    assert got == {"P_1900_A_1": "placeholder", "P_2030_A_1": "future", "P_2024_A_1": "mismatch", "bad": "no year"}


def test_immutable_sees_nulls_and_skips_the_whitelist(spark):
    old = frame(spark, "id int, a string, b string", (1, None, "x"), (2, "s", "x"), (3, "s", "x"))
    new = frame(spark, "id int, a string, b string", (1, "", "y"), (2, "s", "y"), (4, "s", "x"))
    got = {tuple(r) for r in lint.immutable(old, new, "id", ["a", "b"], ["b"]).collect()}
    assert got == {(1, "a", "changed"), (3, "*", "removed")}


def test_review_gate_with_null_keys(spark):
    rows = frame(spark, "a int, b int", (1, 1), (2, None), (None, 3))
    out = gate.review(rows, {"a": frame(spark, "a int", (1,), (None,)), "b": frame(spark, "b int", (3,))})
    assert [tuple(r) for r in out.collect()] == [(2, None)]


def test_daily_lint_warnings_do_not_fail(spark):
    warn = lint.report({"r": ("warning", spark.range(18))})
    row = lint.daily(warn).first()
    assert (row.errors, row.warnings, row.infos, row.lint_pass) == (0, 18, 0, True)
    assert not lint.daily(lint.report({"r": ("error", spark.range(1))})).first().lint_pass


def test_set_diff_counts_multiplicity(spark):
    a, b = frame(spark, "x int", (1,), (1,), (2,), (None,)), frame(spark, "x int", (1,), (3,))
    assert {tuple(r) for r in lint.set_diff(a, b).collect()} == {
        (1, "missing", 1), (2, "missing", 1), (None, "missing", 1), (3, "extra", 1)}


# -- aggregates, coverage, themes ----------------------------------------------------------

def test_distribution_and_buckets(spark):
    df = frame(spark, "t string, c double", ("A", 0.9), ("B", 0.7), ("B", 0.69), (None, None))
    assert sum(r.pct for r in agg.distribution(df, "t").collect()) == pytest.approx(100)
    got = {r.bucket: r.n for r in agg.buckets(df, "c", [("high", 0.85), ("mid", 0.7)], "low").collect()}
    assert got == {"high": 1, "mid": 1, "low": 1, "(none)": 1}  # a missing value is no low one, and not lost


def test_empty_input(spark):
    none = frame(spark, "t string, c double", ("A", 1.0)).limit(0)
    assert agg.distribution(none, "t").count() == 0
    assert {r.n for r in agg.buckets(none, "c", [("high", 0.85)], "low").collect()} == {0}
    assert rank.topk(none, ["t"], [F.col("c")], 3).count() == 0
    assert agg.density(none, none).first().per_mille is None


def test_consensus_conflict_and_aspects(spark):
    df = frame(spark, "doc int, aspect string, p string, s string", *[(1, a, "supportive", s) for a, s in (
        ("price cap", "x"), ("Cap, price", "y"), ("cap  price", "z"), ("cap price", "z"))], (1, "price cap", "critical", "w"))
    normed = opinion.normalize_aspect(df)
    assert {r.aspect_norm for r in normed.collect()} == {"cap price"}
    got = opinion.consensus(normed, "doc", "aspect_norm", "p", "s").collect()
    assert [(r.sources, r.stances) for r in got] == [(3, 4)]
    both = opinion.conflict(normed, ["aspect_norm"], "p", "s", "supportive", "critical").collect()
    assert [(r.pro, r.con, r.sources) for r in both] == [(3, 1, 4)]
    syn = frame(spark, "aspect string, canonical string", ("cap price", "price limit"))
    assert {r.aspect_norm for r in opinion.normalize_aspect(df, syn).collect()} == {"price limit"}


def test_main_issuer_tie_goes_to_the_least_name(spark):
    d = dt.date(2024, 1, 1)
    df = frame(spark, "r string, s int, i string, d date", ("BJ", 4, "b", d), ("BJ", 1, "a", d), ("SH", 5, "c", d))
    got = {r.r: (r.documents, r.high, r.main_issuer) for r in cover.matrix(df, "r", "s", "i", "d").collect()}
    assert got == {"BJ": (2, 1, "a"), "SH": (1, 1, "c")}


def test_gaps_list_themes_without_any_document(spark):
    regions = frame(spark, "r string, m string", ("BJ", "N"), ("TJ", "N"), ("SH", "E"))
    themes = frame(spark, "t string", ("v2g",), ("vpp",))
    docs = frame(spark, "t string, r string", ("v2g", "BJ"), ("v2g", "BJ"), ("v2g", "SH"))
    got = {(r.t, r.m): (r.missing, r.n_regions) for r in cover.gaps(docs, "t", themes, "r", regions, "m").collect()}
    assert got == {("v2g", "N"): (["TJ"], 2), ("vpp", "N"): (["BJ", "TJ"], 2), ("vpp", "E"): (["SH"], 1)}


def test_overlap(spark):
    df = frame(spark, "id int, themes array<string>", (1, ["a", "b", "c"]), (2, ["b", "a", "a"]), (3, ["c"]), (4, None))
    got = {(r.a, r.b): r.documents for r in theme.overlap(df, "themes").collect()}
    assert got == {("a", "b"): 2, ("a", "c"): 1, ("b", "c"): 1}


def test_claims(spark):
    df = frame(spark, "id long, k string, d date, c boolean", (1, "t", dt.date(2025, 6, 1), True),
               (2, "t", dt.date(2026, 3, 27), True), (3, "u", dt.date(2026, 3, 27), False))
    got = {r.id: (r.ordinal, r.predecessor, r.holds) for r in check.ordinal_claims(df, "id", ["k"], "d", F.col("c")).collect()}
    assert got == {1: (1, None, True), 2: (2, 1, False)}


def test_monthly_gap_month_counts_as_zero(spark):
    df = frame(spark, "d date, s int", (dt.date(2024, 1, 5), 4), (dt.date(2024, 1, 9), 5), (dt.date(2024, 3, 1), 4))
    got = {r.month.month: (r.n, r.previous, r.change) for r in report.monthly(df, "d", "s").collect()}
    assert got == {1: (2, 0, 2), 2: (0, 2, -2), 3: (1, 0, 1)}


def test_signals_blank_evidence_is_never_low(spark):
    docs = frame(spark, "id int, w array<string>, r string", (1, ["a"], "x"), (2, ["b"], "x"), (3, ["c"], "x"),
                 (4, ["c"], "y"), (5, ["a", "d"], "x"))
    rules = frame(spark, "term string, business string, weight string, evidence string, region string",
                  ("a", "p", "suppress", "stated", None), ("b", "p", "suppress", None, None),
                  ("c", "p", "medium", "stated", "x"), ("d", "p", "high", "stated", None))
    got = {r.id: r.relevance for r in score.signals(docs, "id", F.col("w"), F.col("r"), rules).collect()}
    assert got == {1: "low", 2: "review", 3: "high", 4: "medium", 5: "high"}


def test_audit_rules_in_order(spark):
    df = frame(spark, "x int", (1,), (5,), (9,))
    out = audit.classify(df, [(F.col("x") > 8, "A", 0.9, "big"), (F.col("x") > 4, "B", 0.5, "mid")])
    assert [(r.type, r.reason) for r in out.collect()] == [("?", "no rule"), ("B", "mid"), ("A", "big")]
    assert [r.x for r in audit.borderline(out).collect()] == [1, 5]


def test_bounded_listing(spark):
    df = spark.range(25).withColumn("g", F.lit("x"))
    out = rank.bounded(df, ["g"], [F.col("id")], 20)
    assert out.count() == 20 and out.first().more == 5


# -- missing values and sketches -----------------------------------------------------------

def test_missing_values_are_classes_of_their_own(spark):
    df = frame(spark, "lv string, nm string, c string", ("a", None, "x"), ("a", "p", None), (None, "p", "odd"), ("a", "p", "x"))
    got = {r.lv: r.names for r in agg.nested_counts(df, "lv", "nm").collect()}
    assert got == {"a": {"(none)": 1, "p": 2}, None: {"p": 1}}
    assert {(r.c, r.n) for r in agg.edge_types(df.withColumnRenamed("c", "c"), "c", ["x", "y"]).collect()} == {
        ("x", 2), ("y", 0), ("odd", 1), ("(none)", 1)}


def test_undated_documents_and_missing_places(spark):
    day = dt.date(2031, 5, 6)
    docs = frame(spark, "id long, t string, d date, s int, lv string, rg string, who string", (1, "t", day, 5, "a", "r", "i"),
                 (2, "t", None, 3, None, None, None), (3, "u", None, 1, "a", "r", None))
    got = {r.t: (r.documents, r.busiest_year, r.years) for r in theme.stats(docs, "t", "d", "s").collect()}
    assert got == {"t": (2, 2031, {2031: 1}), "u": (1, None, {})}
    edges = frame(spark, "t string, src long, dst long, rel string", ("t", 1, 2, "extends"))
    rows = {r.t: r for r in theme.bundle(docs, edges, "t", "id", "lv", "rg", "who", "s").collect()}
    assert rows["t"].region_distribution == {"a": {"r": 1}, "(none)": {"(none)": 1}}
    assert rows["t"].top_issuers == {"i": 1, "(none)": 1} and rows["u"].relations == 0


def test_sketches_of_days_unite(spark):
    rng = random.Random(4)
    rows = [("g", d, f"s{rng.randrange(3000)}") for d in range(10) for _ in range(800)] + [("h", 1, None), ("h", 2, "x")]
    df = frame(spark, "g string, d int, s string", *rows)
    days = agg.sketched(df, ["g", "d"], "s")
    got = {r.g: r.sources for r in agg.united(days, ["g"]).collect()}
    exact = len({s for g, _, s in rows if g == "g"})
    assert abs(got["g"] - exact) <= 0.048 * exact and got["h"] == 1
    top = rank.combined(rank.tracked(df, ["g", "d"], "s"), ["g"], "s", 5_000)
    want = {}
    for g, _, s in rows:
        want[g, s] = want.get((g, s), 0) + (s is not None)
    assert {(r.g, r.s): r.n for r in top.filter("s is not null").collect()} == {k: n for k, n in want.items() if n}


def test_backlog_with_kinds_and_evidence(spark):
    rows = frame(spark, "t string, r string, d int, k string, e string", ("a", "x", 3, "q", "late"), ("a", "x", 1, "p", None),
                 ("a", "y", 2, "p", "early"), ("a", "y", 4, "q", None), (None, "z", 1, None, None))
    got = {r.t: (r.first_seen, r.last_seen, r.ref_count, r.sightings, r.linkage_type, r.evidence_sample)
           for r in backlog.build(rows, "t", "r", "d", "k", "e").collect()}
    assert got == {"a": (1, 4, 2, 4, "p", "early"), None: (1, 1, 1, 1, None, None)}
    plain = backlog.build(rows, "t", "r", "d").columns
    assert plain == ["t", "first_seen", "last_seen", "sightings", "ref_count"]


def test_edges_of_all_relations_in_one_table(spark):
    refs = frame(spark, "src long, dst long, evidence string, pos int", (1, 2, None, 5), (1, 2, "seen", 9), (1, 3, "b", 1), (1, None, "lost", 1))
    chains = frame(spark, "src string, dst string, distance int", ("1", "2", 0), ("7", "8", 3))
    table = rel.edge_table({"references": refs, "iterates": chains}, confidence={"references": 0.9}, source={"iterates": "title"})
    got = {(r.src, r.dst, r.rel): (r.evidence, r.confidence, r.source, r.detail) for r in table.collect()}
    assert got == {("1", "2", "references"): ("seen", 0.9, None, '{"pos":9}'), ("1", "3", "references"): ("b", 0.9, None, '{"pos":1}'),
                   ("1", "2", "iterates"): (None, None, "title", '{"distance":0}'), ("7", "8", "iterates"): (None, None, "title", '{"distance":3}')}


def test_numbers_in_texts_as_mentions(spark):
    docs = frame(spark, "id long, text string", (1, "依据部委［2031］7号。" + "z" * 60 + "废止部委〔2031〕第7号和部委〔2030〕 8 号"), (2, None), (3, "无"))
    hits = link.numbers(docs, "id", "text", ["部委"])
    got = {(r.id, r.mark): (r.pos, r.evidence_count) for r in hits.collect()}
    assert got == {(1, "部委〔2031〕7号"): (1, 2), (1, "部委〔2030〕8号"): (87, 1)}
    refs = rel.references(hits, "id", "mark", frame(spark, "mark string, d long", ("部委〔2031〕7号", 70)), "d")
    assert [(r.id, r.d) for r in rel.supersedes(refs).filter("resolved").collect()] == [(1, 70)]
