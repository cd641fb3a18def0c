import random
import re

import numpy as np
import xxhash

from quotalens.llm import simhash


def brute_fp(t):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                root[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        r = find(i)
        if d is not None:
            least[r] = min(least.get(r, d), d)
    return [least.get(find(i)) for i in range(len(ids))]


def test_query_against_brute_force(edge, empty):
    rows = simhash.op8(edge).collect()
    texts = sorted(((r.doc_id, r.text) for r in edge.collect()), key=str)
    fps = [brute_fp(t) for _, t in texts]
    want = sorted(map(str, zip([i for i, _ in texts], ["%016x" % f for f in fps],
                               brute_components([i for i, _ in texts], fps))))
    assert sorted(map(str, ((r.doc_id, r.fingerprint, r.component_id) for r in rows))) == want
    assert simhash.op8(empty).count() == 0


def test_links_over_many_shards(spark):
    """Random clusters of fingerprints; small shards so that borders matter."""
    rnd, fps = random.Random(5), set()
    for _ in range(120):
        centre = rnd.getrandbits(64)
        fps.add(centre)
        for _ in range(rnd.randint(0, 8)):
            x = centre
            for _ in range(rnd.randint(1, 5)):
                x ^= 1 << rnd.randrange(64)
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f, i) for i, f in enumerate(fps)],
                               "fp long, rep long")
    found = simhash.components(simhash.links(df, 4, shard_points=16))
    got = {r.node: r.component for r in found.collect()}
    assert [got.get(i, i) for i in range(len(fps))] == brute_components(list(range(len(fps))), fps)


def test_one_row_of_each_group_stays(edge, small, empty):
    for docs in (edge, small):
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        fps = [int(f) for f in simhash.simhash([t or "" for _, t in rows])]
        groups = {}
        for k, root in enumerate(brute_components(list(range(len(rows))), fps)):
            groups.setdefault(root, []).append(rows[k])
        kept = simhash.keep_one(docs)
        assert kept.columns == docs.columns and kept.count() == len(groups)
        # of each group the least id that it has, or none
        want = [min((i is None, i or 0) for i, _ in g) for g in groups.values()]
        got = [(r.doc_id is None, r.doc_id or 0) for r in kept.select("doc_id").collect()]
        assert sorted(got) == sorted(want)
    texts = {r.text for r in simhash.keep_one(edge).where("doc_id = 7").collect()}
    assert texts == {"word", "another"}  # one id, unlike texts
    assert simhash.keep_one(empty).count() == 0


def test_ties_at_the_radius_do_not_loop():
    fp = np.array([1 << k for k in range(60)] * 10, np.uint64)
    fp = np.unique(np.concatenate([fp, fp | np.uint64(1 << 62)]))
    root = simhash.link(fp, np.ones(len(fp), bool), 4, simhash.masks()[0], 1)
    assert len(set(root.tolist())) >= 1
