import numpy as np
import xxhash

from aspectra.llm.simhash import bit_planes, bucket_links, fingerprints, simhash_groups, within_radius


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(ids, prints):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, d in enumerate(ids):
        r = find(i)
        if d is not None:
            least[r] = min(d, least.get(r, d))
    return [least.get(find(i)) for i in range(len(ids))]


def test_groups_match_brute_force(documents):
    rows = documents.select("doc_id", "text").collect()
    prints = [brute_fingerprint(r.text) for r in rows]
    want = sorted(zip([r.doc_id for r in rows], prints, components([r.doc_id for r in rows], prints)), key=str)
    got = simhash_groups(documents).collect()
    assert sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got), key=str) == want


def test_long_text_needs_wide_counters():
    text = "a b c " * 2000
    assert int(fingerprints([text.encode()], 3)[0]) % (1 << 64) == brute_fingerprint(text)


def test_bit_sliced_distances():
    rng = np.random.default_rng(1)
    base = rng.integers(-(1 << 62), 1 << 62, 40)
    fp = np.unique(np.concatenate([base] + [base ^ (1 << rng.integers(0, 62)) for _ in range(5)]))
    planes = bit_planes(fp)
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    for radius in (0, 1, 2):
        words = planes.shape[1]
        query, word = np.repeat(np.arange(len(fp)), words), np.tile(np.arange(words), len(fp))
        q, lanes = within_radius(planes, fp[query], np.arange(len(query)), word, np.full(len(query), full), radius)
        found = {(int(query[k]), int(word[k]) * 64 + b) for k, m in zip(q, lanes) for b in range(64) if int(m) >> b & 1 and word[k] * 64 + b < len(fp)}
        want = {(i, j) for i in range(len(fp)) for j in range(len(fp)) if (int(fp[i]) ^ int(fp[j])).bit_count() <= radius}
        assert found == want


def test_bucket_forest_joins_all_links():
    rng = np.random.default_rng(2)
    fp = np.unique(rng.integers(0, 1 << 12, 700))
    u, v = bucket_links(np.zeros(len(fp), np.int64), fp, 2)
    assert len(u) == len(np.unique(u)) == len(fp) - 1 and (v == fp.min()).all()


def test_crowded_keys_are_split_without_loss(spark):
    from aspectra.llm.simhash import fingerprint_links

    prints = sorted({(1 << 40) | (a << 20) | b for a in (1, 2, 4, 8) for b in range(0, 256)})
    links = fingerprint_links(spark.createDataFrame([(p,) for p in prints], "fp long"), 2, crowded=8).collect()
    assert len({n for r in links for n in (r.u, r.v)}) == len(prints)


def test_empty_table(documents):
    assert simhash_groups(documents.limit(0)).count() == 0
