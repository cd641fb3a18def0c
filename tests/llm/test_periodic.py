import hashlib
import random

from quotalens.llm import periodic


def brute(words):
    """All runs by trying every period, with the smallest period checked word by word."""
    out, n = [], len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - s + q
            seg = words[s:s + length]
            if length >= max(6, 4 * q) and not any(seg[r:] == seg[:-r] for r in range(1, q)):
                out.append((s, length, q))
    return sorted(out)


def brute_row(doc_id, text):
    words = (text or "").encode().split()
    words = periodic.edited(words, doc_id)
    found = brute(words)
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    best = sorted(found, key=lambda r: (-r[1], r[0], r[2]))[:1]
    top = (*best[0], 1000 * best[0][1] // best[0][2]) if best else (None,) * 4
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(found), *top, sha("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()),
            sha(b" ".join(w for k, w in enumerate(words) if k not in gone)))


def test_runs_equal_brute_force():
    rnd = random.Random(1)
    for _ in range(1500):
        words = [rnd.randrange(rnd.choice([1, 2, 2, 3, 10])) for _ in range(rnd.randint(0, 50))]
        for _ in range(rnd.randint(0, 3)):
            a, phrase = rnd.randint(0, len(words)), [rnd.randrange(4) for _ in range(rnd.randint(1, 5))]
            words[a:a] = (phrase * 7)[:rnd.randint(1, 30)]
        assert periodic.runs(words) == brute(words)
        if words:  # the automaton alone, without the split into stretches
            assert sorted(periodic.stretch_runs(words)) == brute(words)


def test_access_hands_out_the_longest_common_suffixes():
    rnd = random.Random(2)
    words = [rnd.randrange(2) for _ in range(120)]
    link, longest, ends = periodic.suffix_automaton(words)
    paths = periodic.Paths(link)
    for i, state in enumerate(ends, 1):
        for j, deepest in paths.access(state, i):
            m = longest[deepest]
            if m:
                assert words[i - m:i] == words[j - m:j]
                assert j == m or words[j - m - 1] != words[i - m - 1]


def test_long_stretches_are_not_quadratic():
    assert periodic.runs([1] * 200_000) == [(0, 200_000, 1)]
    block = list(range(4000))
    assert periodic.runs(block * 12) == [(0, 48_000, 4000)]


def test_planted_repeats_follow_the_id():
    words = [b"w%d" % i for i in range(100)]
    hit = [i for i in range(300) if periodic.edited(words, i) != words]
    assert 10 < len(hit) < 60 and periodic.edited([], 3) == [] and periodic.edited(words, None) == words


def test_query_equals_brute_force(spark, edge, small, empty):
    for docs in (edge.where("doc_id <> 11 or doc_id is null"), small):
        got = [tuple(r) for r in periodic.op12(docs).collect()]
        want = [brute_row(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        key = lambda r: (r[0] is not None, r[0] or 0, r[-1])
        assert sorted(got, key=key) == sorted(want, key=key)
    assert periodic.op12(empty).count() == 0
