"""SimHash with pivot tables at a wide radius, as the pipeline's near copies go by it."""

import numpy as np

from eventweft.llm import copies, simhash


def clusters(rng, count, members, words, share):
    base = rng.integers(0, 1 << 63, (count, words)).astype(np.uint64)
    rows = np.repeat(base, members, 0)
    return rows ^ np.packbits(rng.random((len(rows), 64 * words)) < share, axis=1).view(np.uint64)


def test_pivot_tables_prune_exactly():
    rng = np.random.default_rng(1)
    for count, members, words, radius in ((1, 1, 3, 64), (1, 2, 3, 64), (40, 9, 3, 64), (9, 100, 16, 224), (500, 1, 3, 80)):
        prints = clusters(rng, count, members, words, rng.choice([0.02, 0.08, 0.15], (count * members, 1)))
        n = len(prints)
        apart, wide = rng.integers(0, n // 3 + 1, n), np.full(n, radius) + 30 * (rng.random(n) < 0.1)
        differ = [[int(x) for x in np.bitwise_count(prints[i] ^ prints).sum(1, dtype=int)] for i in range(n)]
        want = {(i, j) for i in range(n) for j in range(i) if differ[i][j] <= max(wide[i], wide[j]) and apart[i] != apart[j]}
        got = {(max(p), min(p)) for x, y in simhash.near_pairs(prints, wide, apart) for p in zip(x.tolist(), y.tolist())}
        assert got == want
        label, root = np.arange(n), list(range(n))
        for x, y in simhash.near_pairs(prints, wide, label):
            simhash.joined(label, x, y)
        while (least := [min(root[j] for j in range(n) if differ[i][j] <= max(wide[i], wide[j])) for i in range(n)]) != root:
            root = least
        assert label.tolist() == root


def test_pivots_save_comparisons(monkeypatch):
    """Unlike clusters are not compared with each other, members that a pivot joins not again."""
    done = []
    plain = simhash._distances
    monkeypatch.setattr(simhash, "_distances", lambda a, b: done.append(len(a) * len(b)) or plain(a, b))
    prints = clusters(np.random.default_rng(2), 8, 300, 16, 0.03)
    label = np.arange(len(prints))
    for x, y in simhash.near_pairs(prints, np.full(len(prints), copies.RADIUS), label):
        simhash.joined(label, x, y)
    assert len(set(label.tolist())) == 8 and sum(done) < len(prints) ** 2 / 20


def test_similar_sets_meet_and_stay_within_the_radius():
    rng = np.random.default_rng(3)
    met = {n: 0 for n in (1_000, 200_000, 20_000_000)}
    total = 0
    for size in (5, 6, 12, 20, 40, 100, 300):
        for _ in range(150):
            # the pair of the least similarity allowed, from an edit in place or a removal
            both, left = (round(size * 8 / 9), size - round(size * 8 / 9)) if rng.random() < 0.5 else (-(-size * 4 // 5), 0)
            right = size - both
            while both < 0.8 * (both + left + right):
                both += 1
            drawn = rng.integers(0, 1 << 63, both + left + right).astype(np.uint64)
            a, b = np.sort(drawn[: both + left]), np.sort(np.r_[drawn[:both], drawn[both + left :]])
            assert copies.similarity(a, b) >= 0.8
            x, y = simhash.wide_print(a), simhash.wide_print(b)
            near = copies.radius_of(np.array([min(len(a), len(b))]))[0]
            assert np.bitwise_count(x ^ y).sum() <= near
            assert np.bitwise_count(x ^ y)[: copies.HEAD].sum() <= copies.HEAD_RADIUS
            agree = np.unpackbits(x.view(np.uint8)) == np.unpackbits(y.view(np.uint8))
            total += 1
            for n in met:
                met[n] += agree[copies.bands(n)].all(1).any()
    assert min(met.values()) >= 0.99 * total


def test_fingerprints_find_the_near_copies(spark):
    """Pairs too large for exact keys of segments, among unlike documents: found by fingerprints alone."""
    rng = np.random.default_rng(4)
    rows, keep = [], set()
    for i in range(200):
        own = [f"w{x}" for x in rng.integers(0, 1 << 40, 150)]
        rows.append((2 * i, " ".join(own)))
        keep.add(2 * i)
        other = list(own)
        if i % 2:
            for at in (20, 60, 100)[: i % 3 + 1]:
                other[at] = "changed"
        else:
            other[60:] = ["other"] + other[61:100]
            keep.add(2 * i + 1)
        rows.append((2 * i + 1, " ".join(other)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    marked = frame.selectExpr("doc_id", "xxhash64(text) mark", "text").mapInArrow(
        copies._marked, "doc_id long, mark long, node long, print binary, keys array<long>"
    )
    assert {(len(r.print), len(r["keys"])) for r in marked.filter("doc_id % 4 = 2").collect()} == {(8 * simhash.WORDS + 8, 0)}
    assert {r.doc_id for r in copies.one_of_each(frame).collect()} == keep
