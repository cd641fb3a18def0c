import itertools
import random
import re

from quotalens.llm import paragraphs
from tests.llm.conftest import prose


def words(line):
    return re.findall(rb"[a-z0-9\x80-\xff]+", bytes(c + 32 if 65 <= c <= 90 else c for c in line.encode()))


def brute(rows):
    units = []
    for i, t in rows:
        at = 0
        for line in (t or "").split("\n"):
            w = words(line)
            if len(w) >= paragraphs.LEAST:
                units.append((i, frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)), at))
            at += len(line) + 1
    root = list(range(len(units)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(range(len(units)), 2):
        x, y = units[a][1], units[b][1]
        if len(x & y) >= 0.8 * len(x | y):
            root[find(b)] = find(a)
    groups = {}
    for k, u in enumerate(units):
        groups.setdefault(find(k), []).append((u[0], u[2]))
    return sorted(sorted(g) for g in groups.values() if len(g) > 1)


def test_paragraph_classes_against_brute_force(spark):
    rnd, rows = random.Random(5), []
    lines = [prose(k, rnd.randint(15, 60)).replace("\n", " ") for k in range(40)]
    for i in range(60):
        own = [rnd.choice(lines) for _ in range(3)]
        own = [x.replace("stone", "pebble", 1) if rnd.random() < 0.4 else x for x in own]
        rows.append((i, "\n".join(own)))
    got = paragraphs.op1(spark.createDataFrame(rows, "doc_id long, text string")).where("level = 0").collect()
    groups = {}
    for r in got:
        groups.setdefault(r.class_id, []).append((r.doc_id, r.start))
    assert sorted(sorted(g) for g in groups.values()) == brute(rows)
    for g in groups.values():
        kept = [(r.doc_id, r.start) for r in got if (r.doc_id, r.start) in g and not r.removed]
        assert kept == [min(g)]


def test_a_passage_inside_lines_is_found(spark):
    passage = prose(900, 60).replace("\n", " ")
    rows = [(i, prose(i, 40).replace("\n", " ") + " " + (passage + " " if i < 2 else "") + prose(50 + i, 40).replace("\n", " "))
            for i in range(6)]
    got = paragraphs.op1(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in got} == {0, 1} and {r.doc_id for r in got if r.removed} == {1}


def test_edge_rows(edge, empty):
    ids = {r.doc_id for r in paragraphs.op1(edge).collect()}
    assert {2, -5, 11}.issuperset(ids & {2, -5, 11}) and -5 in ids and 4 not in ids and 5 not in ids
    assert paragraphs.op1(empty).count() == 0


def test_short_passages_are_found_whole(spark):
    """Passages of 51 words, each in two texts of other words: all of their words are reported."""
    rnd, rows, want = random.Random(12), [], {}
    fresh = lambda n: " ".join(f"w{rnd.randrange(10 ** 9)}" for _ in range(n))
    for k in range(60):
        passage = fresh(51)
        for i in (2 * k, 2 * k + 1):
            head = fresh(rnd.randint(5, 40)) + " "
            rows.append((i, head + passage + " " + fresh(rnd.randint(5, 40))))
            want[i] = (len(head), len(head) + len(passage))
    got = paragraphs.op1(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.start, r.end) for r in got} == {(i, *span) for i, span in want.items()}
    assert all(r.removed == (r.doc_id % 2 == 1) and r.words == 51 for r in got)


def test_texts_without_ids_of_their_own_are_kept_apart(spark):
    a, b = (prose(k, 60).replace("\n", " ") for k in (31, 32))
    rows = [(7, a + " " + b), (7, b), (None, prose(33, 40)), (None, a)]
    got = paragraphs.op1(spark.createDataFrame(rows, "doc_id long, text string")).where("level = 1").collect()
    assert sorted((r.doc_id is None, r.removed) for r in got) == \
        [(False, False), (False, True), (False, True), (True, False)]
    assert {r.class_id for r in got if r.removed} == {r.class_id for r in got if not r.removed}


def test_lines_below_twenty_words(spark):
    """Near copies of 19 words, equal lines of 7 and of 2 words; other short lines stay."""
    w = [f"w{k}" for k in range(60)]
    near = w[:18]
    rows = [(0, "\n".join([" ".join([*near, "x"]), " ".join(w[20:27]), "two words"])),
            (1, "\n".join([" ".join([*near, "y"]), " ".join(w[30:37]), "other"])),
            (2, "\n".join([" ".join(w[40:58]), " ".join(w[20:27]).upper(), "two words"]))]
    got = paragraphs.op1(spark.createDataFrame(rows, "doc_id long, text string")).where("level = 0").collect()
    assert sorted((r.doc_id, r.words, r.removed) for r in got) == [
        (0, 2, False), (0, 7, False), (0, 19, False), (1, 19, True), (2, 2, True), (2, 7, True)]


def test_bands_beyond_one_group_lose_no_link(spark, monkeypatch):
    """Clouds of near copies in the same bands, dealt to blocks of 300 words: classes as by brute force."""
    rnd, rows = random.Random(8), []
    for cloud in range(3):
        base = [f"c{cloud}w{k}" for k in range(30)]
        for i in range(70):
            w = list(base)
            for _ in range(rnd.choice([0, 1, 1, 2, 3])):
                w[rnd.randrange(30)] = f"x{rnd.randrange(40)}"
            rows.append((len(rows), " ".join(w)))

    def classes():
        groups = {}
        for r in paragraphs.op1(spark.createDataFrame(rows, "doc_id long, text string")).where("level = 0").collect():
            groups.setdefault(r.class_id, []).append((r.doc_id, r.start))
        return sorted(sorted(g) for g in groups.values())

    whole = classes()
    monkeypatch.setattr(paragraphs, "GROUP", 300)
    assert classes() == whole


def test_hot_links_connect_what_pairs_connect(spark, monkeypatch):
    """One key, two clouds, a chain of members that drifts away, and members like nothing: every pair
    at 0.8 ends in one component, by blocks as by all pairs."""
    rnd, sets = random.Random(4), []
    for cloud in range(2):
        base = list(range(1000 * cloud, 1000 * cloud + 20))
        for _ in range(40):
            s = set(base)
            s.discard(rnd.choice(base))
            s.add(5000 + rnd.randrange(6))
            sets.append(s)
    sets += [set(range(k, k + 20)) for k in range(0, 60, 2)]        # neighbours share 18 of 22
    sets += [set(range(9000 + 30 * k, 9020 + 30 * k)) for k in range(20)]
    frame = spark.createDataFrame([(i, sorted(s)) for i, s in enumerate(sets)], "unit long, set array<long>")
    total = sum(map(len, sets))
    rows = frame.selectExpr("1L key", "unit", f"{total}L size")
    monkeypatch.setattr(paragraphs, "GROUP", 400)
    found = [(r.a, r.b) for r in paragraphs._links(rows, frame).collect()]
    root = {}

    def find(parent, i):
        while parent.get(i, i) != i:
            i = parent[i]
        return i

    for a, b in found:
        root[find(root, a)] = find(root, b)
    want = {}
    for a, b in itertools.combinations(range(len(sets)), 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            want[find(want, a)] = find(want, b)
    parts = lambda p: {frozenset(j for j in range(len(sets)) if find(p, j) == find(p, i)) for i in range(len(sets))}
    assert parts(root) == parts(want)
