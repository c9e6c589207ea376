"""Brute-force comparisons and edge cases of tokenizer alignment, URL filters and Merkle manifests."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from sparkcurate.llm import alignment, catalog, linkgraph, merkle

A_PATH = public_tokenizers.path("byte_bpe_50k.json")
B_PATH = public_tokenizers.path("piece_bpe_32k.model")
CLASHING = ", g string, at long, slice binary, __text string, __keep0 string, host string, digest string, leaf string"
CLASH = ("g", 1, b"s", "t", "k", "h", "d", "l")


# --------------------------------------------------------------------------
# alignment


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    words = ["the", "onthtion", "ñandú", "été", "ﬁne", "x<|endoftext|>y", "don't", "日本", "1234", "  ", "\n", "a\tb", "😀", "<0x41>", "▁"]
    out = [" ".join(rng.choices(words, k=rng.randrange(1, 40))) for _ in range(60)]
    long = " ".join(rng.choices(["alpha", "beta", "gamma,", "7", "delta"], k=40_000))
    return [*out, out[0], out[0], None, "", " ", "  lead", "trail ", "x" * 3000, long, "e\u0301 ½"]


def brute_alignment(texts):
    a_side, b_side = alignment.load_side(A_PATH), alignment.load_side(B_PATH)
    found, count = [], Counter()
    for text in texts:
        found.append(None)
        if not text:
            continue
        # encoded whole, not in pieces
        a = a_side.coder.model.encode(" " + text, add_special_tokens=False).ids
        b = b_side.coder.model.encode(text)
        spans = []
        for side, ids in ((a_side, a), (b_side, b)):
            pieces = [side.coder.pieces[i] for i in ids]
            if b"".join(pieces) != (" " + text).encode():
                break
            ends = np.cumsum([len(p) for p in pieces]).tolist()
            spans.append(list(zip([0, *ends[:-1]], ends)))
        if len(spans) < 2:
            continue
        links, low = [], 0
        for (start, end), x in zip(spans[0], a):
            while spans[1][low][1] <= start:
                low += 1
            j = low
            while j < len(b) and spans[1][j][0] < end:
                links.append((x, b[j]))
                j += 1
        groups, ia, ib = [], 0, 0
        for end in sorted({e for _, e in spans[0]} & {e for _, e in spans[1]}):
            na = next(i for i in range(ia, len(a)) if spans[0][i][1] == end) + 1
            nb = next(i for i in range(ib, len(b)) if spans[1][i][1] == end) + 1
            groups.append(",".join(map(str, a[ia:na])) + "|" + ",".join(map(str, b[ib:nb])))
            ia, ib = na, nb
        count.update(links)
        found[-1] = (len(a), len(b), len(groups), links, sha256(";".join(groups).encode()).hexdigest())
    top = defaultdict(int)
    for (_, y), c in count.items():
        top[y] = max(top[y], c)
    return Counter(
        (0, 0, 0, 0, 0, 0, "") if f is None else
        (*f[:3], len(f[3]), sum(count[p] == top[p[1]] for p in f[3]), sum(count[p] for p in f[3]), f[4]) for f in found)


def test_alignment_matches_brute_force(spark, texts):
    rows = [(i, t, *CLASH) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string" + CLASHING).repartition(3)
    got = alignment.align_documents(docs, A_PATH, B_PATH, ["doc_id"]).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(texts)))
    assert Counter(tuple(r)[1:] for r in got) == brute_alignment(texts)
    assert [tuple(r)[1:] for r in got if r.doc_id in (62, 63)] == [(0, 0, 0, 0, 0, 0, "")] * 2
    assert alignment.align_documents(docs.filter("false"), A_PATH, B_PATH, ["doc_id"]).count() == 0
    assert alignment.align_documents(docs.filter("text is null"), A_PATH, B_PATH, ["doc_id"]).count() == 1


def test_texts_are_cut_where_no_token_crosses(texts):
    """Tokens of whole texts are those of their pieces, also beside white space that is not ASCII."""
    rng = random.Random(9)
    signs = ["a", "é", "don't", "7", " ", "  ", "\u00a0", "\u3000", "\u2028", "\u0085", "\t", "\x1c", "!", "▁", "😀", "\u0301", "'s", "日"]
    mixed = ["".join(rng.choices(signs, k=30)) for _ in range(400)]
    for side in (alignment.load_side(A_PATH), alignment.load_side(B_PATH)):
        for text in mixed + [t for t in texts if t]:
            whole = side.coder.encode([text])[0]
            parts = [i for p in side.coder.encode(alignment.CUT.split(text)) for i in p]
            assert whole == parts or not side.covers(whole, text)
            assert side.covers(whole, text) == all(
                side.covers(ids, p) for p, ids in zip(alignment.CUT.split(text), side.coder.encode(alignment.CUT.split(text))))
    assert not any(b" " in p.lstrip(b" ") for p in alignment.load_side(B_PATH).coder.pieces)


# --------------------------------------------------------------------------
# URL filters

RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"),
         ("block", "com", "/de/"), ("allow", "bad.example.com", "")]


@pytest.fixture(scope="module")
def pages():
    rng = random.Random(4)
    hosts = [f"h{i}.example.{t}" for i in range(12) for t in ("net", "com", "org")] + ["bad.example.com", "com", "notcom", "X.Example.ORG"]
    out = []
    for i in range(400):
        host = "hot.example.net" if i % 3 == 0 else rng.choice(hosts)
        links = [f'<a class=x href="{rng.choice(["http:", "https:", "HTTPS:", ""])}//{rng.choice(hosts)}/p?q">t</a>' for _ in range(rng.randrange(4))]
        links += ["<A HREF='/rel'>", "<a href=mailto:x@y.org>", "<area shape=x href=//h1.example.com#f>", "<a title='<' href=\"//lost.org\">"][: rng.randrange(5)]
        url = f"http://{host}{rng.choice(['/fr/', '/de/', '/en/1', '/es/', '/', ''])}{rng.choice(['x', '?a=/de/', '#t', ''])}"
        out.append((i, url, "<html>" + "\n".join(links)))
    out += [(500, None, None), (501, "no scheme", "<a href=http://h1.example.com>"), (502, "ftp://", ""), (503, "a://b://c/de/", None)]
    return [*out, out[0], out[0], out[7]]


def brute_verdicts(pages):
    lower = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s)

    def split(url):
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        return (lower(m[1]), m[2]) if m else ("", "")

    rows, seeds, links = [], defaultdict(lambda: [0, 0]), set()
    for page, url, html in pages:
        host, path = split(url)
        fits = [(len(h + p), a == "block", h + p, a) for a, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule = max(fits, default=None)
        rows.append((page, host, path, rule and rule[2], rule and rule[3]))
        if rule:
            seeds[host][rule[1]] += 1
        if host:
            for link in re.findall(r"""(?is)<a(?:rea)?\s[^<>]*?\bhref\s*=\s*["']?\s*((?:https?:)?//[^\s"'<>]+)""", html or ""):
                links.add((host, split("x:" + link[link.index("//"):])[0], html))
    edges = Counter((s, d) for s, d, _ in links if s != d and d)

    def spread(kind, turn):
        own = {h: int(n[kind] * linkgraph.SCALE * (1 - 0.85)) for h, n in seeds.items() if n[kind]}
        around = Counter()
        for e, n in edges.items():
            around[e[turn]] += n
        value = dict(own)
        for _ in range(20):
            new = defaultdict(int, own)
            for e, n in edges.items():
                if e[turn] in value:
                    new[e[1 - turn]] += int(value[e[turn]] * (0.85 * n / around[e[turn]]))
            value = dict(new)
        return value

    trust, distrust = spread(0, 0), spread(1, 1)
    return Counter(
        (p, h, path, rule, action or ("block" if distrust.get(h, 0) > trust.get(h, 0) else "allow"))
        for p, h, path, rule, action in rows)


def test_url_verdicts_match_brute_force(spark, pages):
    rows = [(*p, *CLASH[:3], *CLASH[3:]) for p in pages]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string" + CLASHING).repartition(4)
    got = linkgraph.judge_urls(frame, linkgraph.rule_table(spark, RULES), ["page_id"])
    want = brute_verdicts(pages)
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got.collect()) == want
    ruled_by_links = {v[4] for v in want if v[3] is None and v[1]}
    assert ruled_by_links == {"allow", "block"}
    assert linkgraph.judge_urls(frame.filter("false"), linkgraph.rule_table(spark, RULES), ["page_id"]).count() == 0
    nowhere = linkgraph.judge_urls(frame, linkgraph.rule_table(spark, RULES).filter("false"), ["page_id"])
    assert {r.verdict for r in nowhere.collect()} == {"allow"}


def test_url_sql_agrees_on_linked_pages(spark, pages):
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = linkgraph.judge_urls(frame, linkgraph.rule_table(spark, catalog.URL_RULES), ["page_id"])
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", pages)
    want = con.execute(catalog.OP12_SQL)
    names = [c[0] for c in want.description]
    assert Counter(map(tuple, got.select(*names).collect())) == Counter(want.fetchall())


# --------------------------------------------------------------------------
# Merkle manifests


def test_addresses_fill_a_block_without_gaps():
    for height in range(1, 6):
        places = [int(merkle.addresses(height, d, i)) for d in range(height) for i in range(8**d)]
        assert sorted(places) == list(range(len(places)))
        assert merkle.addresses(height, height - 1, np.arange(8 ** (height - 1))).tolist() == [
            int(merkle.addresses(height, height - 1, i)) for i in range(8 ** (height - 1))]
    # half height: the top two levels come first, then each subtree of two levels as one piece
    assert sorted(int(merkle.addresses(4, d, i)) for d in range(2) for i in range(8**d)) == list(range(9))
    assert [int(merkle.addresses(4, 2, 5)), *(int(merkle.addresses(4, 3, 40 + i)) for i in range(8))] == list(range(54, 63))


def brute_manifest(rows):
    node = lambda parts: sha256(b"".join(parts)).hexdigest().encode()
    part = lambda v: b"-" if v is None else b"%d:%s" % (len(str(v).encode()), str(v).encode())
    lower = lambda s: s and "".join(c.lower() if "A" <= c <= "Z" else c for c in s)
    groups = defaultdict(list)
    for r in rows:
        leaf = node(map(part, r))
        told = node(map(part, (*r[:4], lower(r[4])))) if zlib.crc32(str(r[0]).encode()) % 3 == 0 else leaf
        groups[r[2]].append((r[0], leaf, told))

    def levels(leaves):
        out = [leaves]
        while len(out[-1]) > 1:
            out.append([node(out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
        return out

    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([leaf for _, leaf, _ in sorted(groups[g])]) for g in order}
    top = levels([trees[g][-1][0] for g in order])
    out = Counter()
    for number, g in enumerate(order):
        for at, (doc, leaf, told) in enumerate(sorted(groups[g])):
            beside, now = [], told
            for tree, place in ((trees[g], at), (top, number)):
                for level in tree[:-1]:
                    run, own = level[place // 8 * 8 :][:8], place % 8
                    beside += run[:own] + run[own + 1 :]
                    now = node([*run[:own], now, *run[own + 1 :]])
                    place //= 8
            out[(doc, leaf.decode(), trees[g][-1][0].decode(), top[-1][0].decode(), node(beside).decode(), now.decode(), now == top[-1][0])] += 1
    return out


@pytest.mark.parametrize("sizes", [
    {"en": 700, "fr": 513, "de": 64, "es": 8, None: 9, "one": 1, "": 2}, {"en": 1}, {None: 600}, {f"l{i:02}": i + 1 for i in range(11)}])
def test_manifest_matches_brute_force(spark, sizes):
    rng = random.Random(6)
    langs = [g for g, n in sizes.items() for _ in range(n)]
    rng.shuffle(langs)
    texts = ["Été Ä and CAPITALS", "lower", "", None, "Ä ñ"]
    rows = [(i * 3, rng.choice(["s", None, "ß"]), g, rng.choice([None, 4]), rng.choice(texts)) for i, g in enumerate(langs)]
    if len(rows) > 5:
        rows += [rows[3], rows[3], rows[5]]
    frame = spark.createDataFrame(
        [(*r, *CLASH) for r in rows], "doc_id long, source string, lang string, n_chars long, text string" + CLASHING).repartition(5)
    tampered = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3 == 0
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    got = merkle.document_manifest(frame, columns, "lang", ["doc_id"], tampered)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(map(tuple, got.collect())) == brute_manifest(rows)
    assert merkle.document_manifest(frame.filter("false"), columns, "lang", ["doc_id"], tampered).count() == 0
