"""Small brute-force comparisons and edge cases of the corpus operators."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash

from sparkcurate.llm import decontamination, mixing, phrases, quality, recurrence, revisits, sharding, simhash, suffixes, tokens, toxicity
from sparkcurate.llm.common import Scratch
from sparkcurate.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, __text string, k long, key string"
VOCABULARY = ["der", "alpha", "beta", "gamma", "ñandú", "delta", "omega", "zeta", "été", "kappa", "sigma", "tau"]


def prose(rng, n):
    return " ".join(rng.choice(VOCABULARY) + str(rng.randrange(40)) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """Copies, near copies, shared passages, nulls, blanks, one very long text, repeated rows, clashing columns."""
    rng = random.Random(5)
    shared, base = prose(rng, 60), prose(rng, 150)
    texts = [prose(rng, rng.randrange(5, 120)) for _ in range(40)]
    texts += [base] * 12 + [f"{prose(rng, 9)} {shared}\n{prose(rng, 20)}" for _ in range(8)]
    for _ in range(6):
        words = base.split()
        words[rng.randrange(150)] = "other"
        texts.append(" ".join(words))
    texts += [None, "", " \n\t ", "one", "la la la la la " * 30, "x" * 900, "ab" * 700, prose(rng, 20_000), shared[5:]]
    out = [(i, t, rng.choice(["en", None]), rng.choice(["a", "b", None, "ç"]), "clash", i, "k") for i, t in enumerate(texts)]
    return [*out, out[3], out[45]]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def counted(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


def test_phrases_match_brute_force(docs, rows, empty):
    words = [(r[1] or "").encode().split() for r in rows]
    seen = Counter(tuple(w[i : i + 35]) for w in words for i in range(len(w) - 34))
    want = Counter()
    for r, w in zip(rows, words):
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - 34):
            if seen[tuple(w[i : i + 35])] > 1:
                gone[i : i + 35] = True
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        want[r[0], len(w), int(gone.sum()), hashlib.sha256(kept).hexdigest()] += 1
    assert counted(phrases.remove_phrases(docs, ["doc_id"]), "doc_id", "n_words", "n_removed", "kept_sha256") == want
    assert phrases.remove_phrases(empty, ["doc_id"]).count() == 0


@pytest.mark.parametrize("cell", [20_000, 1])
def test_suffixes_match_brute_force(docs, rows, empty, monkeypatch, cell):
    monkeypatch.setattr(suffixes, "CELL_ROWS", cell)  # 1: every gram takes the way of the full cells
    texts = [(r[1] or "").encode() for r in rows]
    seen = Counter(t[i : i + 400] for t in texts for i in range(len(t) - 399))
    want = Counter()
    for r, t in zip(rows, texts):
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - 399):
            if seen[t[i : i + 400]] > 1:
                gone[i : i + 400] = True
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        want[r[0], len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()] += 1
    got = suffixes.remove_repeats(docs, ["doc_id"])
    assert counted(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want
    assert suffixes.remove_repeats(empty, ["doc_id"]).count() == 0


def test_deep_shallow_sorts():
    rng = random.Random(3)
    texts = [bytes(rng.choices(b"ab", k=rng.randrange(0, 90))) for _ in range(300)]
    texts += [b"c" * 60 + bytes(rng.choices(b"ab", k=30)) for _ in range(100)] + texts[:20]
    order, shared = suffixes.deep_shallow(texts)
    placed = [texts[i] for i in order]
    assert placed == sorted(texts)
    assert shared[1:].tolist() == [suffixes.common_prefix(a, b) for a, b in itertools.pairwise(placed)]


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_matches_brute_force(docs, rows, empty):
    prints = [brute_fingerprint(r[1]) for r in rows]
    owner = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 2 and owner[i] != owner[j]:
            low, high = sorted((owner[i], owner[j]))
            owner = [low if o == high else o for o in owner]
    least = {o: min(r[0] for r, p in zip(rows, owner) if p == o) for o in set(owner)}
    want = Counter((r[0], f"{p:016x}", least[o]) for r, p, o in zip(rows, prints, owner))
    assert counted(simhash.near_duplicates(docs), "doc_id", "fingerprint", "component_id") == want
    assert simhash.near_duplicates(empty).count() == 0


def test_full_buckets_lose_no_link(spark):
    rng = random.Random(1)
    centre = rng.getrandbits(62)
    values = sorted({centre ^ (1 << rng.randrange(60)) ^ (1 << rng.randrange(60)) for _ in range(120)})
    frame = spark.createDataFrame([(v,) for v in values], "fp long")
    scratch = Scratch(spark)
    links = simhash.close_links(frame, 2, scratch, bucket_rows=4)
    got = {r.node: r.root for r in components(links, scratch).collect()}
    owner = {v: v for v in values}
    for a, b in itertools.combinations(values, 2):
        if (a ^ b).bit_count() <= 2 and owner[a] != owner[b]:
            low, high = sorted((owner[a], owner[b]))
            owner = {v: low if o == high else o for v, o in owner.items()}
    assert {v: got.get(v, v) for v in values} == owner


def test_one_of_each_class_of_near_copies_stays(docs, rows, empty):
    kept = simhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    near = {r[0] for r in rows if r[1] and len(r[1].split()) == 150 and r[1][:2] != "la"}
    assert len(near & ids.keys()) == 1 and min(near) in ids
    assert max(ids.values()) == 1 and set(range(40)) <= ids.keys()
    assert simhash.keep_one_of_each(empty).count() == 0


def brute_classes(texts, keys):
    """The least key of each text's class, by the Jaccard similarity of all pairs, and the pairs just above the limit."""
    sets = []
    for t in texts:
        words = t.lower().split()
        sets.append({b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))})
    owner, banded = dict(zip(keys, keys)), 0
    for i, j in itertools.combinations(range(len(texts)), 2):
        both = len(sets[i] & sets[j])
        if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both):
            banded += both < 0.85 * (len(sets[i]) + len(sets[j]) - both)
            low, high = sorted((owner[keys[i]], owner[keys[j]]))
            owner = {k: low if o == high else o for k, o in owner.items()}
    many = Counter(owner.values())
    return {k: o for k, o in owner.items() if many[o] > 1}, banded


@pytest.mark.parametrize("common", [0, 8, 1 << 16])
def test_full_buckets_of_texts_lose_no_link(spark, monkeypatch, common):
    """Edits of one text, many too far from it but close to each other, against all pairs by brute force."""
    monkeypatch.setattr(simhash, "COMMON", common)  # the order of the shingles must not matter
    rng = random.Random(5)
    base = [f"w{i}" for i in range(90)]
    texts = {" ".join(base)}
    for _ in range(60):
        words = list(base)
        for _ in range(rng.randint(1, 3)):
            words[rng.randrange(8) * 11] = f"x{rng.randrange(2)}"
        texts.add(" ".join(words))
    texts = sorted(t.encode() for t in texts)
    keys = [i.to_bytes(16, "big") for i in range(len(texts))]
    rows = spark.createDataFrame(list(zip(keys, [t.decode() for t in texts])), "key binary, __text string")
    got = {bytes(r.node): bytes(r.root) for r in simhash.similar_classes(rows, 5, 0.8, 2, Scratch(spark), 3).collect()}
    want = brute_classes(texts, keys)[0]
    assert got == want and len(set(want.values())) > 0


def test_full_blocks_of_unlike_texts_are_ordered_anew(spark, monkeypatch):
    """A line that no sample shows to be common fills blocks of unlike texts; their other shingles tell them apart."""
    monkeypatch.setattr(simhash, "COMMON", 0)
    counted_texts = []
    shared = simhash._shared
    monkeypatch.setattr(simhash, "_shared", lambda texts, *a: counted_texts.append(texts.count()) or shared(texts, *a))
    rng = random.Random(9)
    line = [f"l{i}" for i in range(12)]
    texts = set()
    for _ in range(120):
        words = [f"w{rng.randrange(100000)}" for _ in range(80)]
        texts.add(" ".join(words + line))
        if rng.random() < 0.3:  # one word differs
            texts.add(" ".join([*words[:40], "x", *words[41:], *line]))
    texts = sorted(t.encode() for t in texts)
    keys = [i.to_bytes(16, "big") for i in range(len(texts))]
    rows = spark.createDataFrame(list(zip(keys, [t.decode() for t in texts])), "key binary, __text string")
    got = {bytes(r.node): bytes(r.root) for r in simhash.similar_classes(rows, 5, 0.8, 2, Scratch(spark), 8).collect()}
    want = brute_classes(texts, keys)[0]
    assert got == want and len(want) > 20
    assert sum(counted_texts) == 0


def test_families_of_near_copies_make_few_pairs(spark, monkeypatch):
    """Edits of one text, a third of them too far from it: full blocks of many classes must not propose all pairs."""
    made, paired = [], simhash._paired
    monkeypatch.setattr(simhash, "_paired", lambda *a: made.append(paired(*a)) or made[-1])
    rng = random.Random(12)
    base = [f"w{i}" for i in range(150)]
    texts = {" ".join(base)}
    for i in range(240):
        words = list(base)
        for at in rng.sample(range(150), rng.randint(1, 6)):
            words[at] = f"x{i}-{at}"
        texts.add(" ".join(words))
    texts = sorted(t.encode() for t in texts)
    keys = [i.to_bytes(16, "big") for i in range(len(texts))]
    rows = spark.createDataFrame(list(zip(keys, [t.decode() for t in texts])), "key binary, __text string")
    made_rows = []
    across = simhash._across

    def counted(*args):
        before = len(made)
        out = across(*args)
        made_rows.extend(p.count() for p in made[before:])
        return out

    monkeypatch.setattr(simhash, "_across", counted)
    got = {bytes(r.node): bytes(r.root) for r in simhash.similar_classes(rows, 5, 0.8, 2, Scratch(spark), 8).collect()}
    want = brute_classes(texts, keys)[0]
    assert got == want and 100 < len(want) < len(texts) - 20
    assert sum(made_rows) < 10 * len(texts)


def test_parities_end_links_by_chance_and_keep_all_similar_ones(spark):
    rng = np.random.default_rng(6)
    fresh = lambda n: np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
    sets, links, similar = [], [], set()
    for size in (1, 2, 40, 63, 66, 130, 500, 1020, 1030, 3000):
        one = fresh(size)
        for share in (0.0, 0.3, 0.6, 0.85, 0.89, 0.9, 0.95, 1.0):
            kept = rng.permutation(one)[: round(share * len(one))]
            other = np.unique(np.concatenate((kept, fresh(size - len(kept) + size // 16))))
            both = len(np.intersect1d(one, other))
            at = len(sets)
            sets += [one, other]
            links.append((at, at + 1))
            if both >= 0.8 * (len(one) + len(other) - both):
                similar.add((at, at + 1))
            most = simhash.most_shared(len(one), simhash.parity_of(one), len(other), simhash.parity_of(other))
            assert both <= most
    texts = spark.createDataFrame(
        [(i, len(s), bytearray(simhash.parity_of(s))) for i, s in enumerate(sets)], "id bigint, size int, parity binary")
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    left = {tuple(r) for r in simhash.likely_links(frame, texts, 0.8, Scratch(spark)).collect()}
    assert similar <= left and len(left) < len(links) / 2 < 2 * len(similar)


@pytest.mark.parametrize("bucket_rows", [2, 32])
def test_classes_of_similar_texts_match_all_pairs(spark, bucket_rows):
    """Chains of edits of texts of many lengths, most of them near the limit, and a line in a third of the texts."""
    rng = random.Random(8)
    line, texts = [f"l{i}" for i in range(12)], {b"", b"one", b"one two"}
    for size in (8, 30, 60, 90, 150, 300, 600):
        for _ in range(8):
            words = [f"w{rng.randrange(5000)}" for _ in range(size)] + line * (rng.random() < 0.3)
            for _ in range(4):
                texts.add(" ".join(words).encode())
                words = [f"x{rng.randrange(5000)}" if rng.random() < 0.02 else w for w in words]
                for _ in range(size // 60):
                    words.insert(rng.randrange(len(words)), f"x{rng.randrange(5000)}")
    texts = sorted(texts)
    keys = [i.to_bytes(16, "big") for i in range(len(texts))]
    rows = spark.createDataFrame(list(zip(keys, [t.decode() for t in texts])), "key binary, __text string")
    found = simhash.similar_classes(rows, 5, 0.8, 2, Scratch(spark), bucket_rows).collect()
    want, banded = brute_classes(texts, keys)
    assert {bytes(r.node): bytes(r.root) for r in found} == want
    assert banded > 10


def test_blocks_of_bytes_take_little_memory():
    """A task of op10 finds the anchors of a slice of texts with two more workers beside it."""
    scheme = recurrence.Scheme("bytes", 400, 16)
    text = np.random.default_rng(3).integers(0, 256, 1 << 22, dtype=np.uint8).tobytes()
    recurrence._powers.cache_clear()
    tracemalloc.start()
    starts = sum(int((f.last - f.first + 1).sum()) for f in (
        recurrence.blocks(*chunk, scheme) for chunk in recurrence.chunks([text], recurrence.Speller(scheme))))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert starts == len(text) - 399 and peak < 120 << 20


def test_windows_with_few_words_of_an_item_are_not_counted(monkeypatch):
    words = [f"w{i}".encode() for i in range(10)]
    weight = np.array([10.0] + [1.0] * 9, np.float32)
    basis = np.eye(10, dtype=np.float32)
    model = ({w: i for i, w in enumerate(words)}, weight, basis, [(7, words, 8)], [(0, None)], weight[None, :].copy())
    search = decontamination._search(["doc_id"], *model, decontamination.LeakRules())
    made = []
    monkeypatch.setattr(decontamination, "Counter", lambda x: made.append(x) or Counter(x))
    texts = ["w0 " + "other " * 30, b" ".join(words).decode(), ""]  # the first is near the item by its heaviest word only
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array(texts)], ["doc_id", "__text"])
    rows = [r for out in search(iter([batch])) for r in out.to_pylist()]
    assert [(r["doc_id"], r["item_id"], r["lcs_share"], r["word"]) for r in rows] == [(2, 7, 1.0, 0)]
    assert len(made) == 1


def test_token_counts_and_cache(spark, docs, rows, empty, tmp_path):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    model = Tokenizer.from_file(path)
    want = Counter((r[0], len((r[1] or "").encode()), len(model.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows)
    cache = str(tmp_path / "cache")
    assert counted(tokens.count_tokens(docs, path, cache), "doc_id", "n_bytes", "n_tokens") == want
    stored = spark.read.parquet(cache).count()
    assert stored == len({r[1] or "" for r in rows})
    again = spark.createDataFrame([(1, "one <|endoftext|>"), (2, rows[0][1])], "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in tokens.count_tokens(again, path, cache).collect()}
    assert got[1] == len(model.encode("one <|endoftext|>", add_special_tokens=False).ids)
    assert spark.read.parquet(cache).count() == stored + 1  # only the new text was encoded
    assert tokens.count_tokens(empty, path, cache).count() == 0


def test_mix_meets_targets(docs, rows, empty):
    got = mixing.mix_sources(docs, ["doc_id"], ["doc_id"]).collect()
    assert len(got) == len(rows)
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix_sources(docs.repartition(3), ["doc_id"], ["doc_id"]).collect()))
    size = {r[0]: len(WORD.findall(r[1] or "")) for r in rows}
    names = sorted({r[3] for r in rows if r[3]}) + [None]
    held = {s: sum(size[r[0]] for r in rows if r[3] == s) for s in names}
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, free, rest = {}, set(names), float(sum(held.values()))
    while True:
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        full = {s for s in free if share[s] > 3 * held[s]}
        if not full:
            target |= share
            break
        for s in full:
            target[s] = 3.0 * held[s]
            rest -= target[s]
        free -= full
    taken = Counter()
    source = {r[0]: r[3] for r in rows}
    for r in got:
        assert r["size"] == size[r.doc_id] and r.taken <= 3 * r["size"]
        assert r.target == pytest.approx(target[source[r.doc_id]])
        taken[source[r.doc_id]] += r.taken
    longest = max(size.values())
    assert all(abs(taken[s] - target[s]) <= longest for s in names)
    assert mixing.mix_sources(empty, ["doc_id"], ["doc_id"]).count() == 0
    assert mixing.mix_rows(docs).columns == docs.columns


def test_knapsack_reaches_what_can_be_reached():
    rng = np.random.default_rng(2)
    for _ in range(30):
        lengths = np.unique(rng.integers(1, 60, 6))
        counts = rng.integers(1, 4, len(lengths))
        budget = int(rng.integers(0, (lengths * counts).sum() + 1))
        take = mixing._knapsack(lengths, counts, budget, 10_000)
        sums = {sum(n * int(x) for n, x in zip(c, lengths)) for c in itertools.product(*(range(k + 1) for k in counts))}
        assert (take <= counts).all() and int((take * lengths).sum()) == max(s for s in sums if s <= budget)


def test_budgets_beyond_reach_are_filled():
    assert mixing.fit_counts(np.array([80_000, 90_000]), np.array([3, 3]), 100_000).tolist() == [0, 1]
    rng = np.random.default_rng(3)
    for _ in range(20):
        lengths = np.unique(rng.integers(1, 400_000, 40))
        counts = rng.integers(1, 5, len(lengths))
        budget = int((lengths * counts).sum() * rng.random())
        take = mixing.fit_counts(lengths, counts, budget)
        left = budget - int((lengths * take).sum())
        free = lengths[take < counts]
        assert (take <= counts).all() and 0 <= left and (not len(free) or left < max(free.min(), 1 + budget // 1000))


def test_clashing_names_in_stages(spark, rows, empty):
    """Row-level forms with columns named like those used inside, and with a dot."""
    inner = ["__text", "margin", "score", "shard", "__own", "__own_key", "__key", "__times", "__n", "__digest", "__leaked", "a.b", "c0", "k0"]
    frame = spark.createDataFrame(
        [(r[0], r[1], r[2], r[3], *(f"v{r[0]}" for _ in inner)) for r in rows[:60]],
        "doc_id long, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in inner))
    items = spark.createDataFrame([(0, "one two three four five six seven eight nine ten. eleven twelve.")], "item_id long, text string")
    stages = [simhash.keep_one_of_each, lambda d: decontamination.drop_leaks(d, items), mixing.mix_rows,
              lambda d: toxicity.score_documents(d, d.columns[:5], toxicity.Model())]
    for stage in stages:
        got = stage(frame)
        want = set(frame.columns) if len(got.columns) > 7 else {*frame.columns[:5], "score", "predicted"}
        assert set(got.columns) == want and got.count() > 0
        assert all(r["__text"] == f"v{r.doc_id}" for r in got.collect())
        assert stage(frame.filter("false")).count() == 0
    sharded = sharding.assign_shards(frame)
    assert sharded.columns.count("shard") == 1 and sharded.count() == 60
    assert {r.shard for r in sharded.collect()} <= set(range(16))


def test_shards(docs, rows, empty):
    got = sharding.shard_documents(docs, ["doc_id"], ["doc_id"], shards=4).collect()
    text = {r[0]: r[1] or "" for r in rows}
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    home = {}
    for r in got:
        assert r["size"] == len(text[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode())
        assert home.setdefault(text[r.doc_id], r.shard) == r.shard
    for s in range(4):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert sharding.shard_documents(empty, ["doc_id"], ["doc_id"]).count() == 0
    assert sharding.assign_shards(docs).count() == len(rows)


def test_packing_is_tight():
    rng = random.Random(4)
    sizes = [rng.randrange(1, 1000) for _ in range(3000)]
    bins = Counter()
    for s, b in zip(sizes, sharding.pack_into(sizes, 16)):
        bins[b] += s
    assert len(bins) == 16 and max(bins.values()) - min(bins.values()) < 0.01 * sum(sizes) / 16
    for capacity in (1000, 1500):  # the tree finds what a linear search finds
        rooms, count = [], 0
        for s in sorted(sizes, reverse=True):
            fit = min((r for r in rooms if r >= s), default=None)
            if fit is None:
                count, fit = count + 1, capacity
            else:
                rooms.remove(fit)
            rooms.append(fit - s)
        assert max(sharding.best_fit_decreasing(sizes, capacity)) + 1 == count


def test_statistics_and_outliers(spark, docs, rows, empty):
    def brute(text):
        words, lines, dup = WORD.findall(text), set(), 0
        for line in text.split("\n"):
            if WORD.search(line):
                dup += line in lines
                lines.add(line)
        windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        cover = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
        return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(cover)

    want = Counter((r[0], *brute(r[1] or "")) for r in rows)
    got = quality.reject_outliers(docs, ["doc_id"])
    assert counted(got, "doc_id", *quality.BASE) == want
    assert quality.reject_outliers(empty, ["doc_id"]).count() == 0
    rng = random.Random(6)
    good = [(i, prose(rng, rng.randrange(30, 300)), "en", "a") for i in range(300)]
    bad = [(1000 + i, " ".join(w + "$$$%%%" for w in prose(rng, 80).split()), "en", "a") for i in range(30)]
    frame = spark.createDataFrame(good + bad, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id for r in quality.reject_outliers(frame, ["doc_id"]).filter("kept").collect()}
    assert kept == {r[0] for r in good}


def brute_kernel(s, t, p):
    def parts(x):
        return [("".join(x[i] for i in c), toxicity.DECAY ** (c[-1] - c[0] + 1)) for c in itertools.combinations(range(len(x)), p)]

    return sum(a * b for x, a in parts(s) for y, b in parts(t) if x == y)


def test_subsequence_kernel():
    words = ["idiot", "idxiot", "scum", "aaaa", "onthere", "ñandú"]
    left, right = toxicity.codes(words, 8, -2), toxicity.codes(words, 8, -1)
    for i, a in enumerate(words):
        three, four = toxicity.pair_kernel(np.repeat(left[i : i + 1], len(words), 0), right)
        for j, b in enumerate(words):
            assert three[j] == pytest.approx(brute_kernel(a, b, 3), abs=1e-5)
            assert four[j] == pytest.approx(brute_kernel(a, b, 4), abs=1e-5)


def test_toxic_documents_are_found(spark, empty):
    rng = random.Random(8)
    insults = ["numbskull", "dimwit", "blockhead"]

    def document(i, word):
        words = prose(rng, 60).split()
        if word:
            words[rng.randrange(60)] = word
        return (i, " ".join(words) + ".", int(bool(word)))

    data = [document(i, rng.choice(insults) if i % 4 == 0 else None) for i in range(600)]
    probes = [document(1000, "numb-skull"), document(1001, "d i m w i t"), document(1002, "blockxhead"), document(1003, None)]
    frame = spark.createDataFrame(data + probes + [(2000, None, None), (2001, "", 0)], "doc_id long, text string, toxic int")
    labels = frame.filter("doc_id < 400 or doc_id = 2000").select("doc_id", "toxic")
    rules = toxicity.ToxicityRules(fit_rows=1000)
    model = toxicity.train(frame, labels, rules, Scratch(spark))
    got = {r.doc_id: r for r in toxicity.score_documents(frame, ["doc_id"], model, rules).collect()}
    held = [d for d in data if d[0] >= 400]
    assert sum(got[d[0]].predicted == d[2] for d in held) >= 0.97 * len(held)
    assert [got[i].predicted for i in (1000, 1001, 1002, 1003, 2000, 2001)] == [1, 1, 1, 0, 0, 0]
    none = toxicity.train(empty, labels.filter("false"), rules, Scratch(spark))
    assert {r.predicted for r in toxicity.score_documents(frame, ["doc_id"], none).collect()} == {0}


def test_leaks_and_paraphrases(spark, empty):
    rng = random.Random(9)
    names = ["".join(rng.choices("abcdefghiklmnoprstuv", k=6)) for _ in range(3000)]
    items = [(i, " ".join(rng.choices(names, k=40)) + ". " + " ".join(rng.choices(names, k=6)) + ".") for i in range(25)]
    items += [(90, None), (91, "")]

    def around(text):
        return " ".join(rng.choices(names, k=200)) + " " + text + " " + " ".join(rng.choices(names, k=150))

    def reworded(text):
        return " ".join(rng.choice(names) if rng.random() < 0.15 else w for w in text.split())

    texts = [(i, around(items[i][1])) for i in range(25)] + [(100 + i, around(reworded(items[i][1]))) for i in range(25)]
    texts += [(200 + i, around("")) for i in range(50)] + [(300, None), (301, "")]
    # the question without its answer is no leak
    texts += [(400 + i, around(items[i][1].split(". ")[0])) for i in range(10)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.find_leaks(docs, bench, ["doc_id"]).collect()}
    assert {(i, i) for i in range(25)} <= got and len(got & {(100 + i, i) for i in range(25)}) >= 23
    assert all(d < 200 and d % 100 == i for d, i in got)
    left = {r.doc_id for r in decontamination.drop_leaks(docs, bench).collect()}
    assert left == {d for d, _ in texts} - {d for d, _ in got}
    assert decontamination.find_leaks(empty, bench, ["doc_id"]).count() == 0
    assert decontamination.find_leaks(docs, bench.filter("false"), ["doc_id"]).count() == 0


def test_pairs_of_terms_count_all_windows():
    rng = random.Random(4)
    names = [f"w{i}".encode() for i in range(30)]
    texts = [b" ".join(rng.choice(names + [b"other"] * 60) for _ in range(n)) for n in (0, 1, 15, 16, 17, 47, 48, 49, 200, 333)]
    weight = np.array([0.0] * 3 + [1.0] * 27, np.float32)
    want = Counter()
    for text in texts:
        words = decontamination.terms_of(text)
        for start in range(0, len(words), 16):
            held = Counter(int(w[1:]) for w in words[start : start + 48] if w != b"other" and w not in names[:3])
            want.update({a * 30 + b: held[a] * held[b] for a in held for b in held if a < b})
            want.update({a * 30 + a: n * n for a, n in held.items()})
    batches = lambda: iter([pa.RecordBatch.from_arrays([pa.array(texts)], ["__text"])] * 2)
    for held in (10, 1 << 20):
        got = Counter()
        for out in decontamination._together({w: i for i, w in enumerate(names)}, weight, held)(batches()):
            for r in out.to_pylist():
                got[r["pair"]] += r["n"]
        twice = {key: 2 * n for key, n in want.items()}
        assert got == twice


def test_basis_is_fitted_on_all_documents(spark, monkeypatch):
    """The table of pairs and the singular vectors follow from every row, however many there are."""
    rng = random.Random(14)
    names = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choices(names, k=rng.randrange(120))) for _ in range(2500)]
    docs = spark.createDataFrame([(t,) for t in texts], "__text string").repartition(3)
    items = [(1, [w.encode() for w in names[:40]], 30), (2, [w.encode() for w in names[20:]], 30)]
    seen = []
    basis_of = decontamination.latent_basis
    monkeypatch.setattr(decontamination, "latent_basis", lambda *a: seen.append(a[0]) or basis_of(*a))
    rules = decontamination.LeakRules(rank=10, passes=6, common=1.0)
    vocabulary, weight, basis, *_ = decontamination._block_model(docs, items, rules, Scratch(spark))
    windows = []
    for text in [*texts, *(b" ".join(words).decode() for _, words, _ in items)]:
        words = text.split()
        for start in range(0, len(words), 16):
            row = np.zeros(len(weight))
            for w in words[start : start + 48]:
                row[vocabulary[w.encode()]] += 1
            windows.append(row)
    windows = np.array(windows)
    gram = np.zeros((len(weight),) * 2)
    for r in seen[0].collect():
        a, b = divmod(r["pair"], len(weight))
        gram[a, b] = gram[b, a] = r["n"]
    assert (gram == windows.T @ windows).all()
    best = np.linalg.svd(windows * weight, compute_uv=False)
    held = np.linalg.norm(windows * weight @ basis) ** 2
    assert basis.shape[1] == 10 and held >= 0.98 * (best[:10] ** 2).sum()


def test_leaks_are_dropped_by_a_basis_of_all_documents(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"alpha beta w{i}") for i in range(2300)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    counts, basis_of = [], decontamination.latent_basis
    monkeypatch.setattr(
        decontamination, "latent_basis", lambda pairs, *a: counts.append({r["pair"]: r["n"] for r in pairs.collect()}) or basis_of(pairs, *a))
    assert decontamination.drop_leaks(docs, items).count() <= 2300
    # terms alpha, beta, gamma are 0, 1, 2: the first two stand together in every document and in the item
    assert counts == [{0: 2301, 1: 2301, 2: 1, 4: 2301, 5: 1, 8: 1}]


def test_items_longer_than_a_window_are_found(spark):
    """Verbatim and reworded copies of items of 49 to 500 words, at any place of the hosts."""
    rng = random.Random(21)
    names = ["".join(rng.choices("abcdefghiklmnoprstuv", k=6)) for _ in range(6000)]
    sizes = [49, 64, 150, 200, 200, 300, 500, 500]
    items = [(i, " ".join(rng.choices(names, k=n - 6)) + ". " + " ".join(rng.choices(names, k=6)) + ".")
             for i, n in enumerate(sizes)]
    around = lambda t: " ".join([*rng.choices(names, k=rng.randrange(80)), t, *rng.choices(names, k=150)])
    reworded = lambda t: " ".join(rng.choice(names) if rng.random() < 0.15 else w for w in t.split())
    texts = [(i, around(t)) for i, t in items] + [(100 + i, around(reworded(t))) for i, t in items]
    texts += [(200 + i, around("")) for i in range(30)]
    # one passage of a long item is no leak
    texts += [(300 + i, around(" ".join(t.split()[:60]))) for i, t in items if sizes[i] >= 200]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.find_leaks(docs, bench, ["doc_id"]).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert {(i, i) for i, _ in items} <= got and len(got & {(100 + i, i) for i, _ in items}) >= 6
    assert all(d < 200 and d % 100 == i for d, i in got) and len(found) == len(got)
    assert all(r.lcs_share == r.answer_share == 1.0 for r in found if r.doc_id < 100)
    left = {r.doc_id for r in decontamination.drop_leaks(docs, bench).collect()}
    assert left == {d for d, _ in texts} - {d for d, _ in got}


def test_common_subsequences_of_long_texts_in_parts(monkeypatch):
    rng = random.Random(3)
    for _ in range(20):
        a, b = ([b"%d" % rng.randrange(9) for _ in range(rng.randrange(1, 60))] for _ in range(2))
        whole = decontamination.common_positions(a, b)
        monkeypatch.setattr(decontamination, "CELLS", 100)
        parts = decontamination.common_positions(a, b)
        monkeypatch.undo()
        at = iter(b)
        assert len(parts) == len(whole) and parts == sorted(set(parts)) and all(a[p] in at for p in parts)


def test_revisits_match_brute_force(spark):
    rng = random.Random(11)
    rows = []
    for i in range(400):
        url = rng.choice(["http://www.A.org/x/?b=1&a=2", "https://a.org:443/x?a=2&utm_source=q&b=1#top", "http://b.org/", None, "http://hot.org/p"])
        status = rng.choice([200, 304, 304, 404])
        tag = rng.choice(['"t1"', 'W/"t1"', '"t2"', None])
        headers = {"ETag": tag, "Date": str(i), "Content-Type": "x" if status == 200 else "y"} if tag else None
        rows.append((i, url, rng.randrange(60), status, headers, rng.choice(["d1", "d2", None])))
    schema = "record_id long, url string, captured_at long, status int, headers map<string,string>, payload_digest string"
    got = {r.record_id: r for r in revisits.resolve_revisits(spark.createDataFrame(rows, schema), slots=7).collect()}
    site = {"http://www.A.org/x/?b=1&a=2": "a.org/x?a=2&b=1", "https://a.org:443/x?a=2&utm_source=q&b=1#top": "a.org/x?a=2&b=1",
            "http://b.org/": "b.org", "http://hot.org/p": "hot.org/p", None: None}
    assert got.keys() == {r[0] for r in rows if r[3] == 304}
    bare = lambda h: h and h["ETag"].removeprefix("W/")
    for i, url, at, status, headers, digest in rows:
        if status != 304:
            continue
        earlier = [r for r in rows if r[3] == 200 and url and site[r[1]] == site[url] and r[2] < at]
        best = max(earlier, key=lambda r: (r[2], r[0]), default=None)
        assert got[i].canonical_url == site[url]
        if best is None:
            assert (got[i].verdict, got[i].response_id) == ("no response", None)
            continue
        pair = [(a, b) for a, b in ((bare(headers), bare(best[4])), (digest, best[5])) if a and b]
        verdict = "unverified" if not pair else "resolved" if pair[0][0] == pair[0][1] else "mismatch"
        assert (got[i].verdict, got[i].response_id) == (verdict, best[0])
        if verdict == "resolved" and headers and best[4]:
            assert got[i].headers == {"etag": headers["ETag"], "date": str(i), "content-type": "x"}
    assert revisits.resolve_revisits(spark.createDataFrame([], schema)).count() == 0


def test_pipeline_on_small_tables(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(12)
    item = prose(rng, 40)
    texts = [prose(rng, 80) for _ in range(60)]
    texts += [texts[0]] * 3 + [f"{prose(rng, 30)} {item} {prose(rng, 30)}", None, "you rotten scoundrel " + prose(rng, 20)]
    rows = [(i, t, "en", "ab"[i % 2], len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality long, toxic long").write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard"]
    ids = Counter(r.doc_id for r in out.collect())
    assert 63 not in ids and not {60, 61, 62} & ids.keys() and max(ids.values()) <= 3
