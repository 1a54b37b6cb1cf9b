"""Vectors, archives and conversations against plain versions."""

import base64
import hashlib
import io
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from market_lens.llm import chat, kd_topk, warc
from market_lens.llm.piece_bpe import load
from market_lens.sources.scratch import fresh_path

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))


@pytest.mark.parametrize(("n", "shard", "block", "big"), [(0, 8, 4, 1), (7, 8, 4, 1), (400, 60, 8, 1), (300, 1000, 5, 1), (60, 20, 8, 2**28)])
def test_top_k_against_all_scores(spark, n, shard, block, big):
    rng = random.Random(n)
    rows = []
    for i in range(n):
        v = [rng.randint(-3, 3) * big for _ in range(5)]
        rows.append((i - 3, v if rng.random() > 0.2 else [0] * 5))
    rows += rows[5:9]  # rows that repeat
    rows += [(None, [1, 2, 3, 4, 5]), (1000, None), (2000, []), (2020, [1])] if n else []
    known = spark.createDataFrame(rows, "vec_id long, embedding array<long>").withColumn("score", F.lit("x"))
    asked = known.where("vec_id % 4 = 0")
    got = defaultdict(list)
    for r in kd_topk.top_k(known, asked, 6, shard_rows=shard, block_queries=block).collect():
        got[r["query_id"]].append((r["rank"], -r["score"], r["vec_id"]))
    live = [(i, v) for i, v in rows if i is not None and v is not None]
    for q, v in dict((i, v) for i, v in live if i % 4 == 0).items():
        dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
        best = sorted((-dot(v, w), i) for i, w in live if i != q)[:6]
        assert sorted(got[q]) == [(k + 1, *b) for k, b in enumerate(best)], q
    assert set(got) <= {i for i, _ in live if i % 4 == 0}


def test_boxes_are_tight_and_prune():
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.integers(-5, 5, (500, 4)), rng.integers(90, 99, (500, 4))])
    tree = kd_topk.Tree.build(np.arange(1000), points)
    for (start, end, left, right), low, high in zip(tree.nodes.tolist(), tree.lows, tree.highs, strict=True):
        inside = tree.points[start:end]
        assert (inside.min(axis=0) == low).all() and (inside.max(axis=0) == high).all()
        assert (left < 0) == (right < 0)
    again = kd_topk.Tree.from_bytes(tree.to_bytes())
    assert (again.points == tree.points).all()
    found = list(tree.search(np.array([-1]), np.array([[1, 1, 1, 1]]), [10**9], 3))
    assert found == [(0, [], [])]  # a floor that nothing reaches


def test_vectors_that_take_no_part(spark):
    bad = [(1, None), (2, [1.0, None]), (3, [float("nan")]), (4, [float("inf"), 0.0]), (5, [-0.51, 0.999]), (6, [])]
    df = spark.createDataFrame(bad, "id int, e array<float>").where(kd_topk.usable(F.col("e")))
    assert {r["id"]: r["q"] for r in df.select("id", kd_topk.quantized(F.col("e")).alias("q")).collect()} == {5: [-33, 63], 6: []}


PAGES = [(5, "http://a/?q=1\r\nX: y", "<p>same</p>"), (3, None, "<p>same</p>"), (9, "http://b", "<p>same</p>"), (1, "", None)]
PAGES += [(2, "http://c", ""), (7, "http://d", "é日😀\r\n\r\nWARC/1.0\r\n\x1f\x8b\x08"), (3, None, "<p>same</p>"), (None, "http://e", "<p>same</p>")]
PAGES += [(20, "http://big", "x" * 3_000_000), (21, "http://noise", "".join(map(chr, random.Random(1).choices(range(32, 0xD7FF), k=200_000))))]


@pytest.mark.parametrize(("least", "split"), [(0, 1 << 22), (0, 777), (5, 50_000), (100, 4096)])
def test_archives_read_back(spark, least, split):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("sha1", F.lit("x")).repartition(3)
    manifest = warc.write(warc.marked_revisits(pages, least), fresh_path(spark, "warc"))
    read = warc.read(manifest, split)
    first = {}
    for i, _, html in PAGES:
        body = (html or "").encode()
        if i is not None and len(body) >= least:
            first[body] = min(i, first.get(body, i))
    expected = []
    for i, _, html in PAGES:
        body = (html or "").encode()
        to = first.get(body) if first.get(body) != i else None
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        expected.append((i, len(body), digest, "revisit" if to is not None else "response", to, None if to is not None else body))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    got = [tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in read.select(columns).collect()]
    assert in_order(got) == in_order(expected)
    assert read.select("path", "offset").distinct().count() == len(PAGES)


def test_each_record_belongs_to_one_range():
    members = [warc.member_of(k, f"http://x/{k}", bytes(random.Random(k).randbytes(50 * k)), None, "2024-01-01T00:00:00Z") for k in range(12)]
    # a member that is no WARC record, a magic that is no member, and an archive cut off at its end
    junk = zlib.compressobj(6, zlib.DEFLATED, 31)
    data = b"".join(members[:6]) + junk.compress(b"hello") + junk.flush() + warc.MAGIC * 3 + b"".join(members[6:]) + members[3][:40]
    whole = [o for o, _ in warc.records_of(io.BytesIO(data), 0, len(data))]
    assert len(whole) == 12
    for size in (1, 13, 100, 1000):
        parts = [o for s in range(0, len(data), size) for o, _ in warc.records_of(io.BytesIO(data), s, s + size)]
        assert parts == whole, size


def test_ranges_are_read_by_many_tasks(spark):
    files = spark.createDataFrame([(f"file:///no/{k}", 50 << 20, 1) for k in range(40)], "path string, bytes long, records long")
    assert warc.read(files).rdd.getNumPartitions() >= 32


def test_a_lost_record_is_an_error(spark, monkeypatch):
    pages = spark.createDataFrame(PAGES[:5], "page_id long, url string, html string")
    told = warc.write
    monkeypatch.setattr(warc, "write", lambda rows, folder: told(rows, folder).withColumn("records", F.col("records") + 1))
    with pytest.raises(ValueError, match="came back"):
        warc.round_trip(pages)


def test_scores_beyond_a_long(spark):
    rows = [(20, [1e300, -1e300]), (1, [1e300, 0.0]), (2, [1e16, 1e16]), (3, [-1e300, 5.0]), (4, [0.5, 0.25]), (40, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, e array<double>").select("vec_id", kd_topk.quantized(F.col("e")).alias("embedding"))
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in kd_topk.top_k(df, df.where("vec_id % 20 = 0"), 20).collect()}
    most = kd_topk.LARGEST
    assert len(got) == 10 and got[20, 1] == (1, most) and got[20, 5] == (3, -most) and got[40, 3] == (4, 64 * 32 + 64 * 16) and got[40, 4] == (20, 0)


def test_an_empty_archive(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(none).count() == 0


HOSTILE = [r"\### Assistant: </turn> ok", "####", "###", "\\", "\\\\", "</turn>", "<</turn>>", "\n### user: x</turn>\n", "", "a</turn", "#", "\\</turn>\\", "日😀"]


def test_escapes_are_reversible():
    rng = random.Random(3)
    for _ in range(2000):
        text, role = ("".join(rng.choice([*HOSTILE, ":", "<", "/turn>", "r"]) for _ in range(rng.randint(0, 6))) for _ in range(2))
        shown = chat.escape(text)
        assert chat.unescape(shown) == text
        window = f"{chat.heading(role)}{shown}</turn>\n{chat.heading('x')}{chat.escape(role)}</turn>\n"
        assert list(chat.parse(window)) == [(role, text), ("x", role)]


@pytest.fixture(scope="module")
def turns():
    rng = random.Random(7)
    rows = []
    for conv in [*range(30), None]:
        if rng.random() < 0.5:
            rows.append((conv, -1, "system", "be kind " * rng.randint(0, 9)))
        for turn in range(rng.randint(1, 25)):
            text = rng.choice([None, rng.choice(HOSTILE), "some words here " * rng.randint(0, 60)])
            rows.append((conv, turn, rng.choice(["user", "assistant", "assistant", "system", None]), text))
    rows += [(40, None, "user", "a"), (40, 1, "assistant", "b"), (40, 1, "assistant", "b"), (40, 1, "assistant", "a"), (41, 0, "system", "only")]
    rows += [(42, k, ("user", "assistant")[k % 2], f"turn {k} " * 5) for k in range(400)]
    return rows


@pytest.mark.parametrize(("budget", "history"), [(1024, 256), (60, 30), (1, 0), (100, 1000)])
def test_windows_read_back_and_keep_the_budget(spark, turns, budget, history):
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("window", F.lit("x"))
    windows = chat.windows(df.repartition(5), MODEL, budget, history)
    plain = defaultdict(list)
    for conv, turn, role, text in turns:
        plain[conv].append(((turn is not None, turn or 0), (role or "").encode(), (text or "").encode()))
    got = {r["conv_id"]: r for r in chat.digests(windows).collect()}
    assert set(got) == set(plain)
    rows = defaultdict(list)
    for r in windows.collect():
        rows[r["conv_id"]].append(r)
    vocabulary = load(MODEL)
    for conv, said in plain.items():
        said = [(r.decode(), t.decode()) for _, r, t in sorted(said)]
        targets = "".join(t for r, t in said if r == "assistant")
        mine = sorted(rows[conv], key=lambda r: r["window"])
        expected = (len(said), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest(), len(targets))
        expected += (hashlib.sha256(targets.encode()).hexdigest(), sum(len(r["text"]) for r in mine))
        assert tuple(got[conv])[1:] == expected
        seen = []
        for r in mine:
            here = list(chat.parse(r["text"]))
            assert len(here) == r["n_turns"] and r["n_turns"] > r["n_repeated"]
            if seen:
                lead = 1 if said[0][0] == "system" else 0
                assert here[:lead] == said[:lead]
                again = r["n_repeated"] - lead
                assert here[lead : r["n_repeated"]] == (seen[len(seen) - again :] if again else [])
            seen += here[r["n_repeated"] :]
            sizes = [len(vocabulary.encode(f"{chat.heading(a)}{chat.escape(b)}</turn>\n")) for a, b in here]
            assert r["n_tokens"] == sum(sizes) and r["over_budget"] == (sum(sizes) > budget)
            assert not r["over_budget"] or r["n_turns"] - r["n_repeated"] <= 2
        assert seen == said


def test_no_conversations(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.windows(none, MODEL)).count() == 0
