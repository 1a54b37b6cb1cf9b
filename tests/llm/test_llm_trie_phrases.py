"""Prefix trie, fertility rules and collocations against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from brute import DOCS, edge_docs, with_clashes
from pyspark.sql import functions as F

import public_tokenizers
from market_lens.llm import fertility, phrases, prefix_trie

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TURNS = "conv_id long, turn long, role string, text string"


# Prefix trie ------------------------------------------------------------------------------


def plain_rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def plain_trie(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        kids = children[node]
        leaves[node] = sum(leaves[k] for k in kids) if kids else 1
        size = len(node[-1][1].encode()) if node else 0
        saved[node] = sum(saved[k] for k in kids) + (len(members[node]) - 1) * size
    out = Counter()
    for node, convs_in in members.items():
        ends = sorted(c for c in convs_in if len(convs[c]) == len(node))
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        parent = min(members[node[:-1]]) if node else None
        out[(min(convs_in), len(node), parent, len(convs_in), len(children[node]), leaves[node], saved[node], digest)] += 1
    return out


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def found(df):
    return Counter(tuple(r[c] for c in COLUMNS) for r in df.collect())


def conversations(rng, n=90):
    rows = []
    for c in range(-7, n):
        if c % 11 == 3:
            continue  # some groups lack their first conversation
        size = rng.choice([1, 1, 2, 4, 9, 14])
        for t in range(size):
            rows.append((c, t, rng.choice(["user", "assistant"]) if t else "user", rng.choice(["a", "b", "é", ""]) if t < 4 else rng.choice("xy")))
    rows += [(200, None, None, None), (200, 5, "user", None), (None, 0, "user", "lost"), (201, 1, "a", "bc"), (202, 1, "ab", "c")]
    rows += [(c, t, "user", "same") for c in (300, 301, 302, 303) for t in range(30)]  # copies
    rows += [(300, 30, "user", "one more")]
    return rows


@pytest.mark.parametrize("unit", [100_000, 7, 1])
def test_trie_like_nested_prefixes(spark, unit):
    """However the sorted conversations are cut into ranges."""
    rows = conversations(random.Random(4))
    df = with_clashes(spark.createDataFrame(rows, TURNS)).repartition(5)
    keys = prefix_trie.rebuilt(df)
    assert {r["conv_id"]: len(r["key"]) // 16 for r in keys.collect()} == {c: len(t) for c, t in plain_rebuilt(rows).items()}
    result = prefix_trie.trie(keys, unit)
    assert found(result) == plain_trie(plain_rebuilt(rows))


def test_trie_of_conversations_as_they_are(spark):
    rows = conversations(random.Random(5), 40)
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    plain = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    assert found(prefix_trie.trie(prefix_trie.keyed(spark.createDataFrame(rows, TURNS)), 9)) == plain_trie(plain)


def test_trie_edges(spark):
    empty = spark.createDataFrame([], TURNS)
    assert prefix_trie.trie(prefix_trie.rebuilt(empty)).count() == 0
    turnless = [(0, 0, "user", "a"), (4, 0, "user", "b")]  # 4 keeps nothing of its own where h > 0
    assert found(prefix_trie.trie(prefix_trie.rebuilt(spark.createDataFrame(turnless, TURNS)))) == plain_trie(plain_rebuilt(turnless))
    lone = [(c, 0, "user", "b") for c in range(1, 5)]
    assert found(prefix_trie.trie(prefix_trie.rebuilt(spark.createDataFrame(lone, TURNS)), 1)) == plain_trie(plain_rebuilt(lone))
    long = [(0, t, "user", "x" * (t % 7)) for t in range(5000)] + [(1, t, "user", "x" * (t % 7)) for t in range(5000)]
    result = prefix_trie.trie(prefix_trie.rebuilt(spark.createDataFrame(long, TURNS)), 1)
    assert result.count() == 5001 and result.agg(F.max("saved_tokens")).first()[0] == sum(t % 7 for t in range(5000))


def test_nodes_grow_through_all_layouts():
    keys = sorted(bytes([a, b]) + b"tail" for a in range(256) for b in ((0, 1) if a % 2 else (0,)))
    root = prefix_trie.tree(keys)
    assert root.kind == 256 and len(root.ordered()) == 256
    for size, kind in ((4, 4), (5, 16), (16, 16), (17, 48), (48, 48), (49, 256)):
        node = prefix_trie.tree([bytes([255 - k, 0]) for k in range(size)])
        assert node.kind == kind and len(node.ordered()) == size
        assert [keys[0] for keys in [bytes([255 - c.first]) for c in node.ordered()]] == sorted(255 - k for k in range(size))
        assert all(node.get(255 - k) is not None for k in range(size)) and node.get(0) is None
    assert prefix_trie.tree([b"abcd" * 9, b"abcd" * 9 + b"x"]).end == 36  # one compressed path


# Fertility --------------------------------------------------------------------------------


def plain_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside), failed


def test_base_counts_like_the_definition(spark):
    rng = random.Random(8)
    rows = edge_docs(rng)
    rows += [(900 + k, " ".join(rng.choice("abc") for _ in range(rng.randint(1, 60))) + "\n \n#x\n#x\nb\n b", "en", "s", 1) for k in range(30)]
    rows += [(990, "a\x1cb\x85c\xa0d e\x0bf\x0cg\r\nh", "en", "s", 1), (991, "z " * 70_000, "en", "s", 1)]
    result = fertility.verdicts(with_clashes(spark.createDataFrame(rows, DOCS)).repartition(4), MODEL)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    ours = Counter((r["doc_id"], *(r[n] for n in names)) for r in result.collect())
    assert ours == Counter((i, *plain_base(t)) for i, t, *_ in rows)
    assert result.where("base_failed and kept").count() == 0
    assert fertility.verdicts(spark.createDataFrame([], DOCS), MODEL).count() == 0


def test_measures_like_the_library():
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rng = random.Random(2)
    texts = ["", "a", "日本語 ☃ ☃", "one two\nthree", " ".join(rng.choice(["alpha", "  beta", "γ", "𝔘"]) for _ in range(90_000))]
    for text in texts:
        n, spelled, entropy = fertility.measures(MODEL, text)
        ids = library.encode(text)
        assert n == len(ids)
        assert spelled == sum(library.is_byte(i) and library.id_to_piece(i) not in ("<0x0A>", "<0x09>") for i in ids)
        if n > 1:
            shares = np.array(list(Counter(ids).values())) / n
            assert entropy == pytest.approx(-(shares * np.log2(shares)).sum() / np.log2(min(n, 32_000)))


def test_bands_reject_what_is_unlike_its_language(spark):
    rng = random.Random(6)
    words = ["the", "house", "under", "water", "reading", "table", "green", "morning", "without", "people", "because", "little"]
    usual = [(k, " ".join(rng.choices(words, k=rng.randint(60, 100))), "en", "s", 1) for k in range(300)]
    odd = [
        (1000, " ".join("".join(rng.choices("qxzjkvw", k=9)) for _ in range(80)), "en", "s", 1),  # many tokens a word
        (1001, " ".join("☃𝔘⌘"[k % 3] * 3 for k in range(80)), "en", "s", 1),  # bytes
        (1002, " ".join("house water" if k % 9 else "the" for k in range(40)), None, "s", 1),
    ]
    result = {r["doc_id"]: r for r in fertility.verdicts(spark.createDataFrame(usual + odd, DOCS), MODEL).collect()}
    base = {i for i, r in result.items() if r["base_failed"]}
    assert all(result[k]["kept"] for k in range(300) if k not in base) and len(base) < 30
    assert "chars_per_token" in result[1000]["rejected_by"] and "byte_share" in result[1001]["rejected_by"]
    assert [fertility.script(t) for t in ("Ab", "Привет a", "漢字かな漢", "12 %", "א", "")] == ["latin", "cyrillic", "han", "none", "hebrew", "none"]


# Collocations -----------------------------------------------------------------------------


def plain_phrases(rows, least, top, cover=80):
    counts = defaultdict(Counter)
    totals = Counter()
    for text, lang in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for n in range(1, 5):
                for i in range(len(words) - n + 1):
                    counts[lang or "und"][tuple(words[i : i + n])] += 1
    out = {}
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        covered = set()
        for p, a in candidates.items():
            for n in range(2, len(p)):
                for i in range(len(p) - n + 1):
                    if 100 * a >= cover * f[p[i : i + n]]:
                        covered.add(p[i : i + n])
        ranked = []
        for p, a in candidates.items():
            if p not in covered:
                score, _, l, r = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(ranked)[:top], 1):
            out[(lang, rank)] = (p.decode(), -a, l, r, totals[lang], -score)
    return out


def collocated(df):
    return {(r["lang"], r["rank"]): (r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in df.collect()}


@pytest.mark.parametrize("modulus", [1, 2, 16, 10**9])
def test_collocations_like_plain_counts(spark, modulus, monkeypatch):
    """However the texts are parsed: at every place, at some, or never."""
    rng = random.Random(9)
    words = ["of", "the", "New", "york", "a", "b", "ß", "日本", "\x00", "x-y", "\xa0"]
    rows = []
    for k in range(150):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", "\n", ",", " "]) for _ in range(rng.randint(0, 60)))
        rows.append((k, text, rng.choice(["en", "de", None]), "s", 1))
    rows += [(500, None, "en", "s", 1), (None, "", None, None, None), (501, "a " * 300 + "b", "en", "s", 1), (501, "a " * 300 + "b", "en", "s", 1)]
    df = with_clashes(spark.createDataFrame(rows, DOCS)).repartition(3)
    plain = plain_phrases([(t, lang) for _, t, lang, *_ in rows], 5, 40)
    assert collocated(phrases.collocations(df, 5, 40, modulus=modulus)) == plain
    assert plain


def test_long_texts_are_cut_without_changing_a_count(spark, monkeypatch):
    rng = random.Random(10)
    text = " ".join(rng.choice(["a", "b", "cc", "ddd"]) for _ in range(60_000)) + "\n" + ". ".join("p q r" for _ in range(20_000))
    pieces = [(phrases.normalized(text.encode())[s:e], ends) for s, e, ends in phrases._segments(phrases.normalized(text.encode()))]
    assert len(pieces) == 1
    monkeypatch.setattr(phrases, "SEGMENT", 5000)
    data = phrases.normalized(text.encode())
    counted = Counter()
    for s, e, ends in phrases._segments(data):
        assert e - s < 6000
        for start, end, n in zip(*(a.tolist() for a in phrases.chunks(data[s:e], not ends))):
            w = data[s:e][start:end].decode().split(" ")
            for k in range(1, 5):
                for i in range(min(n, len(w) - k + 1)):
                    counted[tuple(w[i : i + k])] += 1
    want = Counter()
    for piece in data.decode().split("\n"):
        w = piece.split()
        for k in range(1, 5):
            want.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    assert counted == want


def test_hashes_of_spans_do_not_depend_on_their_place():
    rng = np.random.default_rng(1)
    word = rng.integers(0, 255, 17, np.uint8)
    data = rng.integers(0, 255, 5 * phrases.SEGMENT, np.uint8)
    places = np.array([3, phrases.SEGMENT, 2 * phrases.SEGMENT - 5, 4 * phrases.SEGMENT + 11])
    for p in places:
        data[p : p + 17] = word
    assert len(set(phrases.Hasher(data)(places, places + 17).tolist())) == 1
    lone = phrases.Hasher(word)(np.array([0]), np.array([17]))[0]
    assert lone == phrases.Hasher(data)(places, places + 17)[0]


def test_collocation_edges(spark):
    assert phrases.collocations(spark.createDataFrame([], DOCS)).count() == 0
    with pytest.raises(ValueError):
        phrases.collocations(spark.createDataFrame([], DOCS), longest=5)
    rows = [(k, "same words here", None, "s", 1) for k in range(40)]
    got = collocated(phrases.collocations(spark.createDataFrame(rows, DOCS)))
    assert got == {("und", 1): ("same words here", 40, 40, 40, 120, 1000000)}
    pairs = collocated(phrases.collocations(spark.createDataFrame(rows, DOCS), longest=2))
    assert [v[0] for v in pairs.values()] == ["same words", "words here"]
