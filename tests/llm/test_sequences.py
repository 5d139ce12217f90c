"""Prefix trie, fill-in-middle and packing against brute force, with their edge cases."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import prefix_trie, queries, seekable_frames, two_fit

# --- prefix trie ------------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, n long, dg string"


def brute_trie(rows):
    """The contract, turn by turn in dictionaries."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        turns = own.get(base, [])[:h] + own[c][h:]
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out, totals = [], {}
    for node in sorted(members, key=len, reverse=True):
        leaves = 1 if not children[node] else sum(totals[x][0] for x in children[node])
        saved = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        totals[node] = (leaves, saved + sum(totals[x][1] for x in children[node]))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
        out.append((min(members[node]), len(node), parent, len(members[node]), len(children[node]), *totals[node], digest))
    return sorted(out, key=str)


def trie_of(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], TURNS)
    return sorted((tuple(r) for r in prefix_trie.conversation_trie(df).collect()), key=str)


def conversations(seed, n, longest):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for turn in range(rng.randrange(1, longest)):
            rows.append((c, turn, rng.choice(["user", "assistant"]), rng.choice(["a", "b", "déjà"])))
    return rows


def test_trie_equals_brute_force(spark):
    rows = conversations(3, 40, 14)
    rows += [(7, None, None, None), (7, 3, "user", None), (7, 3, "user", "a"), (7, 3, "user", "a"), (None, 0, "user", "a")]
    rows += [(1001, 0, "user", "x"), (1003, 5, None, ""), (-3, 0, "user", "a"), (-5, 1, "user", "a")]
    assert trie_of(spark, rows) == brute_trie(rows)


def test_trie_of_copies_one_long_conversation_and_shared_openings(spark):
    copies = [(c, t, "user", f"turn {t}") for c in range(100, 700) for t in range(9)]
    long = [(5, t, "user" if t % 2 else "assistant", str(t % 7)) for t in range(1000)]
    rows = copies + long + conversations(4, 5, 4)
    assert trie_of(spark, rows) == brute_trie(rows)


@pytest.mark.parametrize("rows", [[], [(None, 1, "user", "a")], [(11, 0, "user", "a")], [(c, 0, "user", "a") for c in (10, 11, 12)], [(1000, 0, None, None)]])
def test_small_tries(spark, rows):
    found = trie_of(spark, rows)
    assert found == brute_trie(rows)
    assert (found == []) == all(r[0] is None for r in rows)


def test_conversations_without_a_turn_are_members_of_the_root(spark):
    # without their neighbour, and with fewer turns than they would take over, conversations have none
    rows = [(c, 0, "user", "a") for c in range(100, 140) if c % 5]
    found = trie_of(spark, rows)
    assert found == brute_trie(rows)
    assert sum(1 for c, *_ in rows if zlib.crc32(str(c).encode()) % 9) > 0


def test_ids_of_a_node_are_hashed_in_runs(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "_IDS", 3)
    whole = spark.createDataFrame([(c, 1, bytearray(b"k")) for c in range(20)] + [(50, 2, bytearray(b"k"))], "c long, n long, dg binary")
    found = {r["q"]: r["sha"] for r in prefix_trie._ends(whole).collect()}
    assert found == {0: hashlib.sha256(",".join(map(str, range(20))).encode()).hexdigest(), 50: hashlib.sha256(b"50").hexdigest()}


# --- fill in middle ---------------------------------------------------------------------------



def lines(text):
    parts = text.split("\n")
    return [p + "\n" for p in parts[:-1]] + ([parts[-1]] if parts[-1] else [])


def brute_example(doc_id, text, seed=7, fim_rate=100, spm_rate=50):
    text = text or ""
    u = lines(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= fim_rate:
        return doc_id, len(u), "plain", None, None, text
    a, b = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    spm = h[3] % 100 < spm_rate
    out = f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, len(u), "spm" if spm else "psm", len(p), len(m), out


TEXTS = [
    None, "", "\n", "\n\n", "one", "one\n", "a\nb\r\nc\x85d e\n", "é日本\n𝄞x\n" * 3, "<P>", "x\n<M>y", "<\nP>", "a<\nS>b\n<S\n", "line\n" * 2000,
    "ö" * 5000, "<S", "x<P", "\x00\n\x00", "long " * 30000 + "\n" + "tail",
]


def examples(spark, rows, frame_bytes, **options):
    docs = spark.createDataFrame([(i, t, "n", 1) for i, t in rows], "doc_id long, text string, frames string, n int")
    made = seekable_frames.fill_in_middle(seekable_frames.store(docs, frame_bytes=frame_bytes), **options)
    told = made.withColumn("d", seekable_frames.digests("frames", "form")).withColumn("out", seekable_frames.text_of("frames"))
    return told.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "out", "d.*", "frames").collect()


@pytest.mark.parametrize("frame_bytes", [4, 64, 1 << 16])
def test_fill_in_middle_equals_brute_force(spark, frame_bytes):
    texts = TEXTS if frame_bytes > 4 else [t for t in TEXTS if len(t or "") < 6000]
    rows = [*enumerate(texts), (None, "a\nb\nc"), (4, "one"), (4, "other\ntwo")]
    found = {}
    for r in examples(spark, rows, frame_bytes):
        found.setdefault(tuple(r[:6]), r)
    assert set(found) == {brute_example(i, t) for i, t in rows}
    whole = {i: t or "" for i, t in rows if i != 4 and i is not None}
    for key, r in found.items():
        assert r["output_sha256"] == hashlib.sha256(key[5].encode()).hexdigest()
        if r["doc_id"] in whole:
            assert r["restored_sha256"] == hashlib.sha256(whole[r["doc_id"]].encode()).hexdigest()


def test_both_orders_and_rates(spark):
    rows = [(i, f"a{i}\nb\nc\n") for i in range(60)]
    for rates in ({"fim_rate": 50, "spm_rate": 0}, {"spm_rate": 100}, {"seed": 3}):
        found = {tuple(r[:6]) for r in examples(spark, rows, 1 << 16, **rates)}
        assert found == {brute_example(i, t, **rates) for i, t in rows}
    assert {r["form"] for r in examples(spark, rows, 1 << 16)} == {"psm", "spm"}


def test_frames_are_bounded_reused_and_one_stream(spark):
    text = "".join(f"line {i}\n" for i in range(5000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    stored = seekable_frames.store(docs, frame_bytes=1000)
    frames = [bytes(f["data"]) for f in stored.first()["frames"]]
    assert all(len(zstandard.ZstdDecompressor().decompress(f)) <= 1000 for f in frames)
    made = [bytes(f) for f in seekable_frames.fill_in_middle(stored).first()["frames"]]
    assert len(set(frames) - set(made)) <= 2  # all but the frames that are cut stand in the example as they are
    stream = zstandard.ZstdDecompressor().stream_reader(b"".join(made), read_across_frames=True).read()
    assert stream.decode() == brute_example(1, text)[-1]


def test_a_place_opens_one_frame():
    codec = seekable_frames.Codec()
    parts = list(seekable_frames.split(("é\n" * 1000).encode(), 100))
    opened = []
    text = seekable_frames.Text(
        codec, 1000, [codec.pack(p) for p in parts], np.cumsum([p.count(b"\n") for p in parts]).tolist(), np.cumsum([len(p.decode()) for p in parts]).tolist()
    )
    real, codec.open = codec.open, lambda f: opened.append(f) or real(f)
    place = text.place(517)
    assert text.chars_before(place) == 1034 and len(opened) == 2 and len(set(opened)) == 1


def test_no_rows(spark):
    assert examples(spark, [], 64) == []


# --- packing ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(two_fit.tokenizer_path())
    found.encode_special_tokens = True
    return found


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "word", " ", "  ", "\n", "\t", "don't", "42", "日本", "é", "\x85", "\xa0", "​", "\x1c", "<|endoftext|>", "!?", "𝄞"]), max_size=25))
def test_ids_are_those_of_the_tokenizer_file(tokenizer, parts):
    text = "".join(parts)
    ids = np.frombuffer(two_fit.encoder(two_fit.tokenizer_path()).encode(text), "<u4").tolist()
    assert ids == tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_are_those_of_the_tokenizer_file_on_documents(spark, tokenizer):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    texts += [" " * 2_000_000, "\n" * 500_000, "ab" * 500_000, "x \n" * 200_000]
    encoder = two_fit.Encoder(two_fit.tokenizer_path())
    assert encoder.ranked is not None
    for text, whole in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == whole.ids


def test_files_of_another_kind_go_to_the_tokenizer_library():
    from tokenizers import Tokenizer

    encoder = two_fit.Encoder(two_fit.tokenizer_path("word_bpe_49k.json"))
    assert encoder.ranked is None
    plain = Tokenizer.from_file(two_fit.tokenizer_path("word_bpe_49k.json"))
    assert np.frombuffer(encoder.encode("Some Words, here"), "<u4").tolist() == plain.encode("Some Words, here", add_special_tokens=False).ids


def one_by_one(lengths, size):
    """The method on single pieces: fill greedily, then widen by the shortest for two that fit more tightly."""
    left, bins = sorted(lengths), []
    while left:
        held, gap = [], size
        for x in sorted(left, reverse=True):
            if x <= gap:
                held.append(x)
                gap -= x
        for x in held:
            left.remove(x)
        while len(held) > 1 or held[0] < size:
            shortest = min(held)
            free = left + [shortest]
            pairs = [(a + b, a) for i, a in enumerate(free) for b in free[i + 1 :] if a + b <= gap + shortest]
            total = max(pairs, default=(0, 0))[0]
            if total <= shortest:
                break
            pair = max((max(a, b), min(a, b)) for i, a in enumerate(free) for b in free[i + 1 :] if a + b == total)
            held.remove(shortest)
            left.append(shortest)
            for x in pair:
                left.remove(x)
                held.append(x)
            gap -= total - shortest
        bins.append(sorted(held))
    return sorted(bins)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=60), st.integers(30, 40))
def test_fillings_of_counts_are_those_of_single_pieces(lengths, size):
    made = [sorted(k for k, n in f.uses.items() for _ in range(n)) for f in two_fit.solve(Counter(lengths), size) for _ in range(f.times)]
    assert sorted(made) == one_by_one(lengths, size)


def test_two_pieces_replace_a_loose_one():
    # greedy: 60 + 30, gap 10; taking 30 out again leaves room for 21 + 19
    fillings = two_fit.solve(Counter([60, 30, 21, 19]), 100)
    assert sorted(fillings[0].uses) == [19, 21, 60] and len(fillings) == 2


def test_work_does_not_grow_with_the_number_of_pieces():
    some = two_fit.solve({k: 3 + k % 11 for k in range(1, 2049)})
    many = two_fit.solve({k: 10**9 + k % 11 for k in range(1, 2049)})
    assert len(many) < 8 * 2048 and len(some) < 8 * 2048
    assert sum(f.times * k * n for f in many for k, n in f.uses.items()) == sum(k * (10**9 + k % 11) for k in range(1, 2049))


def check_packed(rows, docs, tokenizer, size):
    """Every document's pieces give its tokens back, every sequence is full of them without a gap."""
    pieces, places = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] and 0 < len(ids) <= size
        pieces[r["doc_id"]].append((r["piece"], r["start"], ids))
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    tokens = defaultdict(list)
    for i, text in docs:
        tokens[i].append(tokenizer.encode(text or "", add_special_tokens=False).ids + [0])
    assert set(pieces) == set(tokens)
    for i, found in pieces.items():
        if len(tokens[i]) == 1:
            found.sort()
            assert [x for _, _, ids in found for x in ids] == tokens[i][0]
            assert [s for _, s, _ in found] == np.cumsum([0, *(len(x[2]) for x in found)])[:-1].tolist()
            assert [p for p, _, _ in found] == list(range(len(found)))
            assert all(len(ids) == size for _, _, ids in found[1:]) and len(found) == -(-len(tokens[i][0]) // size)
    for held in places.values():
        held.sort()
        assert [o for o, _ in held] == np.cumsum([0, *(n for _, n in held)])[:-1].tolist() and sum(n for _, n in held) <= size
    return len(places)


def test_pack_with_nulls_long_texts_and_repeated_rows(spark, tokenizer):
    rng = random.Random(1)
    docs = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 90)))) for i in range(300)]
    docs += [(1000, None), (1001, ""), (1002, "x " * 1000), (1003, "\n" * 70), (None, "q"), (None, "q"), (5, docs[5][1]), (1004, "a b " * 63 + "a"), (1005, "é" * 400)]
    df = spark.createDataFrame([(*d, 1, b"z") for d in docs], "doc_id long, text string, length int, ids binary").repartition(5)
    packed = two_fit.pack(df, size=128)
    sequences = check_packed(packed.collect(), docs, tokenizer, 128)
    total = sum(len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in docs)
    assert sequences <= -(-total // 128) + 2
    joined = two_fit.sequences(packed)
    assert joined.count() == sequences and joined.agg(F.sum(F.octet_length("ids"))).first()[0] == 4 * total


def test_pack_many_pieces_of_one_length(spark):
    df = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("a b c d").alias("text")).repartition(16)
    packed = two_fit.pack(df, size=16).select("sequence_id", "offset", "length")
    per = packed.groupBy("sequence_id").agg(F.count("*").alias("n"), F.collect_set("offset").alias("o"))
    assert per.count() == 6667 and per.where("n = 3 and size(o) = 3").count() == 6666


def test_pack_nothing(spark):
    assert two_fit.pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []


# --- queries over the given tables ------------------------------------------------------------


def test_packing_query(spark, tokenizer):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    rows = queries.QUERIES["op13_best_two_fit"](spark, "/root/testdata/sf0.01").collect()
    tokens = {i: tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for i, t in docs}
    for r in rows:
        ids = np.array(tokens[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4")
        assert r["ids_crc32"] == zlib.crc32(ids.tobytes())
    used, total = len({r["sequence_id"] for r in rows}), sum(map(len, tokens.values()))
    assert sum(r["length"] for r in rows) == total and used <= 1.01 * total / 2048 + 1
