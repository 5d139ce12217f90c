"""Neighbours, archives, scoring, toxicity, language, preferences and the pipeline against brute force."""

import base64
import hashlib
import math
import random
import zipfile
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tidemark.llm import adaptive_scan, cross_parsing, mixing, pattern_grammar, preferences, pseudo_likelihood, zip_warc
from tidemark.llm.queries import ORACLES, QUERIES
from tidemark.llm.tables import held_out, table, training_row
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, score string, language string"


# --- neighbours


def exact(rows, k):
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v) and len(v) == 8:
            good.setdefault(i, []).append(np.array(v))
    out = {}
    for q, vectors in good.items():
        if q % 20 == 0:
            scores = {}
            for query in vectors:
                for i, others in good.items():
                    if i != q:
                        scores[i] = max([scores.get(i, -math.inf), *(float(o @ query) for o in others)])
            out[q] = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:k]
    return out


def test_neighbours_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 8)]) for i in range(400)]
    rows += [(500 + i, rows[7][1]) for i in range(60)]  # one very common vector
    rows += [(1000, None), (1001, []), (1002, [0.0] * 8), (1003, [1.0] * 7 + [None]), (1004, [math.nan] * 8), (1005, [math.inf] + [1.0] * 7), (1006, [1.0]), (None, [1.0] * 8), rows[20], (40, [1.0] * 8)]
    table = spark.createDataFrame([(*r, 1, "z") for r in rows], "vec_id long, embedding array<double>, rank int, list string")
    got = {}
    for r in adaptive_scan.neighbours(table, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    wanted = exact(rows, 20)
    assert got.keys() == wanted.keys()
    for q, near in wanted.items():
        assert [(n + 1, i) for n, (i, _) in enumerate(near)] == [x[:2] for x in sorted(got[q])]
        assert np.allclose([s for _, s in near], [x[2] for x in sorted(got[q])], rtol=1e-12)


def test_probed_lists_reach_recall(spark):
    rng = np.random.default_rng(6)
    spread = rng.standard_normal((30, 16)) * 3
    rows = [(i, [float(x) for x in spread[i % 30] + rng.standard_normal(16)]) for i in range(3000)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = adaptive_scan.neighbours(table, F.col("vec_id") % 100 == 0, list_rows=100).collect()
    vectors = np.array([v for _, v in rows])
    hit = 0
    for q in range(0, 3000, 100):
        scores = vectors @ vectors[q]
        scores[q] = -math.inf
        mine = [r.vec_id for r in got if r.query_id == q]
        assert len(mine) == 20
        hit += len(set(mine) & set(np.argsort(-scores)[:20].tolist()))
    assert hit / 600 >= 0.9


def test_sample_spans_a_table_in_order(spark):
    rng = np.random.default_rng(8)
    n, spread = 60_000, np.random.default_rng(9).standard_normal((300, 16)) * 2
    vectors = spread[np.arange(n) // 200] + rng.standard_normal((n, 16))  # rows ordered by cluster
    table = spark.createDataFrame([(i, v) for i, v in enumerate(vectors.tolist())], "vec_id long, embedding array<double>")
    asked = range(0, n, 500)
    got = {}
    for r in adaptive_scan.neighbours(table, F.col("vec_id") % 500 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    recall = []
    for q in asked:
        scores = vectors @ vectors[q]
        scores[q] = -math.inf
        recall.append(len(got[q] & set(np.argsort(-scores)[:20].tolist())) / 20)
    half = len(recall) // 2
    assert min(np.mean(recall[:half]), np.mean(recall[half:])) >= 0.9, (np.mean(recall[:half]), np.mean(recall[half:]))


def test_few_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert adaptive_scan.neighbours(empty, F.col("vec_id") % 20 == 0).count() == 0
    two = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in adaptive_scan.neighbours(two, F.col("vec_id") % 20 == 0).collect()] == [(0, 1, 1, 3.0)]


# --- archives


def test_archives_give_back_the_pages(spark, folder):
    rows = [(1, "http://a/ b\r\nx", "<p>é🙂</p>"), (2, None, "same"), (5, "u", "same"), (3, "v", "same"), (7, "e", ""), (8, "n", None), (None, "k", "same"), (None, "m", "alone"), (9, "big", "x" * 2_000_000), (5, "u", "same")]
    pages = spark.createDataFrame([(*r, "no", 3) for r in rows], "page_id long, url string, html string, record_type string, first int").repartition(3)
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in zip_warc.archive_pages(pages, folder, archive_bytes=1).collect())

    def expected(i, html):
        data = (html or "").encode()
        ids = [k for k, _, h in rows if (h or "") == (html or "") and k is not None]
        to = max(ids) if ids and i != max(ids) and len([1 for _, _, h in rows if (h or "") == (html or "")]) > 1 else None
        return i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if to is not None else "response", to

    assert got == Counter(expected(i, h) for i, _, h in rows)
    files = sorted(Path(folder).glob("*.zip"))
    assert len(files) == len(rows) and not list(Path(folder).glob(".*zip.????????*"))
    for file in files:  # any ZIP reader and any gzip reader can read them
        with zipfile.ZipFile(file) as z:
            assert z.testzip() is None and set(z.namelist()) == {zip_warc.DATA, zip_warc.INDEX}


def test_no_pages(spark, folder):
    assert zip_warc.archive_pages(spark.createDataFrame([], "page_id long, url string, html string"), folder).count() == 0


def test_directories_of_64_bits(tmp_path, monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("first", b"0123456789abcdef")
        z.writestr("second", b"more of it, beyond the limit")
        z.comment = b"PK\x05\x06 in a comment"
    data = (tmp_path / "a.zip").read_bytes()
    read = lambda at, n: data[at : at + n]
    assert b"PK\x06\x06" in data
    members = zip_warc.directory(read, len(data))
    for name, body in (("first", b"0123456789abcdef"), ("second", b"more of it, beyond the limit")):
        at = zip_warc.stored_at(read, members[name])
        assert data[at : at + members[name].size] == body
    with pytest.raises(ValueError):
        zip_warc.directory(lambda at, n: b"x" * n, 100)


# --- language-model scores


def test_gradient_is_the_slope():
    rng = np.random.default_rng(0)
    ids, at = rng.integers(0, pseudo_likelihood.VOCABULARY, 60), np.array([0, 25, 25, 60])
    around, flat = pseudo_likelihood.contexts(ids, at), pseudo_likelihood.initial().astype(np.float64)
    trainer = pseudo_likelihood.Trainer(flat)
    before = trainer.flat.copy()
    trainer._step(ids, around)
    assert pseudo_likelihood.log_probabilities(trainer.flat, ids, around).sum() > pseudo_likelihood.log_probabilities(before, ids, around).sum()
    slope = -(trainer.flat - before) * np.sqrt(trainer.squares) / trainer.rate
    for place in rng.choice(np.flatnonzero(np.abs(slope) > 1e-4), 12):
        moved = [flat.copy(), flat.copy()]
        moved[0][place] += 1e-4
        moved[1][place] -= 1e-4
        a, b = (-pseudo_likelihood.log_probabilities(m, ids, around).mean() for m in moved)
        assert abs((a - b) / 2e-4 - slope[place]) < 1e-3 + 0.05 * abs(slope[place])


def test_contexts_stay_in_their_document():
    around = pseudo_likelihood.contexts(np.array([5, 6, 7, 8]), np.array([0, 3, 3, 4]))
    pad = pseudo_likelihood.VOCABULARY
    assert around.T.tolist() == [[pad, pad, 6, 7], [pad, 5, 7, pad], [5, 6, pad, pad], [pad, pad, pad, pad]]


def test_probabilities_sum_to_one():
    flat = pseudo_likelihood.initial(3)
    ids = np.arange(pseudo_likelihood.VOCABULARY)
    around = np.tile(np.array([[1], [2], [3], [4]]), len(ids))
    assert abs(np.exp(pseudo_likelihood.log_probabilities(flat, ids, around)).sum() - 1) < 1e-5


def test_order_scores_above_disorder(spark):
    rng = random.Random(1)
    cycle = [f"t{i}" for i in range(40)]
    texts = [" ".join(cycle[(s + i) % 40] for i in range(200)) for s in rng.choices(range(40), k=900)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    flat = pseudo_likelihood.fit(docs)
    shuffled = texts[0].split()
    rng.shuffle(shuffled)
    rows = [(1, texts[0], "a", "b", "c"), (2, " ".join(shuffled), "", "", ""), (3, None, "", "", ""), (4, " \n", "", "", ""), (1, texts[0], "", "", ""), (None, "t1", "", "", "")]
    out = pseudo_likelihood.score(spark.createDataFrame(rows, DOCS), flat).collect()
    assert len(out) == 6
    known = {r.doc_id: r for r in out}
    assert known[1].mean_log_probability > known[2].mean_log_probability + 1 and known[1].n_tokens == 200
    assert (known[3].n_tokens, known[3].log_likelihood, known[3].mean_log_probability) == (0, 0.0, None) == (known[4].n_tokens, known[4].log_likelihood, known[4].mean_log_probability)
    assert known[None].n_tokens == 1
    assert (pseudo_likelihood.fit(docs.limit(0)) == pseudo_likelihood.initial()).all()


@pytest.mark.parametrize("common", [pseudo_likelihood.COMMON, 4])
def test_words_of_one_token_have_their_own_probabilities(spark, common, monkeypatch):
    monkeypatch.setattr(pseudo_likelihood, "COMMON", common)
    token = lambda w: int(pseudo_likelihood.tokens(pa.array([w], pa.large_string()))[0][0])
    often, other, unseen = [w for w in (f"w{i}" for i in range(20_000)) if token(w) == token("w0")][:3]
    texts = [f"{often} {often} a b c", f"{often} a b {other} c", f"a {other} {often} b", " ".join(f"n{i}" for i in range(50))] * 3 + [None]
    counted = Counter(w for t in texts for w in (t or "").split())
    totals = Counter()
    for w, n in counted.items():
        totals[token(w)] += n
    schema, flat = "doc_id long, text string", pseudo_likelihood.initial(5)
    counts = pseudo_likelihood.word_counts(spark.createDataFrame(list(enumerate(texts)), schema).repartition(3))
    assert sorted(r.n for r in counts.collect()) == sorted(counted.values())
    tried = [f"a {often} b", f"a {other} b", f"a {unseen} b", f"{unseen} n1 n2 {often} {unseen}", "n3", None]
    out = {r.doc_id: r for r in pseudo_likelihood.score(spark.createDataFrame(list(enumerate(tried)), schema), flat, words=counts).collect()}
    for i, t in enumerate(tried):
        ids, at = pseudo_likelihood.tokens(pa.array([t or ""], pa.large_string()))
        wanted = pseudo_likelihood.log_probabilities(flat, ids, pseudo_likelihood.contexts(ids, at)).sum()
        wanted += sum(math.log(max(1, counted[w]) / (totals[token(w)] + 1)) for w in (t or "").split())
        assert abs(out[i].log_likelihood - wanted) < 1e-9 and out[i].n_tokens == len((t or "").split())
    assert out[0].log_likelihood > out[1].log_likelihood > out[2].log_likelihood


# --- toxicity


def brute_readings(clause):
    """Symbols with the marks that each machine on its own would give."""
    out, target, reach, reported = [], False, 0, False
    for s in clause:
        if s in "IT":
            out.append(s + "a" * target + "d" * (reach > 0) + "r" * reported)
        else:
            out.append(s)
        reach = pattern_grammar.REACH if s == "N" else max(0, reach - 1)
        target, reported = target or s == "Y", reported or s == "R"
    return out


def test_composition_equals_each_machine():
    rng, machine = random.Random(9), pattern_grammar.grammar()
    for _ in range(400):
        clause = rng.choices("ITYNR.", k=rng.randrange(9))
        state, got = machine.start, []
        for s in clause:
            state, emitted = machine.step(state, s)
            got.append(emitted)
        assert got == brute_readings(clause)


def test_more_labels_than_are_learned(spark):
    rows = [(k, f"{chr(0x430 + k % 32)}{chr(0x430 + k // 32)}слово слово", f"l{k}", "", "") for k in range(400)]
    rows += [(1000 + k, "the plain words of a text that is english " * 3, "en", "", "") for k in range(20)] + [(2000, "", "en", "", ""), (2001, None, None, "", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, x string")
    model = cross_parsing.fit(docs)
    assert len(model.languages) == 200 and "en" in model.languages
    found = {r.doc_id: r.lang_pred for r in cross_parsing.identify(docs, model).collect()}
    assert found[1003] == "en" and found[2000] == found[2001] == "und" and len(found) == len(rows)


def test_scripts_do_not_share_letters(spark):
    """Languages of scripts with more letters together than any alphabet holds."""
    rng = random.Random(3)
    scripts = {"ru": (0x430, 32), "el": (0x3B1, 24), "hi": (0x905, 50), "ja": (0x3042, 80), "zh": (0x4E00, 900), "zh2": (0x5E00, 900), "ka": (0x10D0, 33)}
    words = {n: ["".join(chr(a + rng.randrange(size)) for _ in range(rng.randrange(2, 6))) for _ in range(60)] for n, (a, size) in scripts.items()}
    rows = [(k, " ".join(rng.choice(words[n]) for _ in range(30)), n, "", "") for k, n in enumerate(n for n in scripts for _ in range(40))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, x string")
    model = cross_parsing.fit(docs.where("doc_id % 4 <> 1"))
    found = cross_parsing.identify(docs.where("doc_id % 4 = 1"), model).collect()
    assert [r.lang_pred for r in found] == [r.lang for r in found] and len(found) == 70


def test_scores_do_not_depend_on_the_layout(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    one, many = (pseudo_likelihood.fit(docs.repartition(n), shard_bytes=60_000) for n in (1, 16))
    assert np.abs(one - many).max() < 1e-4
    a, b = ({r.doc_id: r.mean_log_probability for r in pseudo_likelihood.score(docs, w).collect()} for w in (one, many))
    assert max(abs(a[d] - b[d]) for d in a if a[d] is not None) < 1e-3


def toxic_rows(n, seed):
    rng = random.Random(seed)
    plain = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    rows = []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randrange(20, 80))]
        bad = rng.random() < 0.3
        if bad:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(["grobian", "knuckleheaded", "blockheads"])
        rows.append((i, " ".join(words) + ".", int(bad)))
    return rows


def test_toxicity_on_rows_not_learned_from(spark):
    rows = toxic_rows(800, 2)
    docs = spark.createDataFrame([r[:2] + ("x", "y", "z") for r in rows], DOCS)
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(None, 1), (5000, 1), (3, None)], "doc_id long, toxic int")
    model = pattern_grammar.fit(docs, labels.where(training_row()))
    extra = spark.createDataFrame([(9000, None, "", "", ""), (9001, "", "", "", ""), (9002, "grobian. " * 20_000, "", "", "")], DOCS)
    out = {r.doc_id: r.score for r in pattern_grammar.score(docs.union(extra), model).where(held_out() | (F.col("doc_id") >= 9000)).collect()}
    assert all((out[i] >= 0.3) == bool(y) for i, _, y in rows if i in out) and len(out) > 150
    assert out[9000] == out[9001] < 0.3 and out[9002] > 0.9
    reader = pattern_grammar._reader(model.lexicon)
    weight = lambda t: pattern_grammar._scores(reader.features(t)[None, :], np.array(model.weights))[0]
    assert weight("you will kill him. you kill.") > weight("we kill time.") > weight("we talk.")
    threats = {"I will kill you.": True, "we kill time.": False, "I will not hurt you.": False, "he said not to kill her.": False, "they said: he wants to kill her.": False}
    assert {t: bool(weight(t) >= 0.3) for t in threats} == threats


def test_toxicity_with_repeated_rows_and_ties(spark):
    rows = toxic_rows(300, 4)
    docs = spark.createDataFrame([r[:2] + ("x", "y", "z") for r in rows], DOCS)
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    one, twice = (pattern_grammar.fit(docs, both) for both in (labels, labels.union(labels).repartition(7)))
    assert one.lexicon == twice.lexicon and np.allclose(one.weights, twice.weights)
    scored = pattern_grammar.score(docs.union(docs), one).groupBy("doc_id").agg(F.countDistinct("score").alias("n"), F.count("*").alias("rows"))
    assert {(r.n, r["rows"]) for r in scored.collect()} == {(1, 2)}


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a", "", "", "")], DOCS)
    model = pattern_grammar.fit(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r.score for r in pattern_grammar.score(docs, model).collect()] == [0.0]
    assert pattern_grammar.score(docs.limit(0), model).count() == 0


# --- language


def greedy_phrases(text, known, alphabet):
    """The parse by definition: from each place the longest run that occurs in the known text."""
    n, i = 0, 0
    while i < len(text):
        j = i + 1
        while j < len(text) and text[i : j + 1] in known:
            j += 1
        n, i = n + 1, j
    return n


def test_phrases_equal_their_definition():
    rng = random.Random(3)
    model = cross_parsing.LanguageModel(("x", "y"), tuple("".join(rng.choices("ab c", k=200)) for _ in range(2)))
    parser = cross_parsing._Parser(model)
    texts = ["".join(rng.choices("abcd -", k=n)) for n in (0, 1, 7, 100, cross_parsing.SEGMENT, cross_parsing.SEGMENT * 3 + 5)]
    got, _, letters = parser.phrases(texts)
    for k, known in enumerate(model.texts):
        name = lambda codes: "".join(chr(48 + c) for c in codes)
        spelled = name(parser._codes([known])[0])
        for t, n in zip(texts, got[k]):
            codes = name(parser._codes([t])[0])
            pieces = [codes[i : i + cross_parsing.SEGMENT] for i in range(0, len(codes), cross_parsing.SEGMENT)]
            assert n == sum(greedy_phrases(p, spelled, None) for p in pieces)
    assert letters.tolist() == [sum(c.isalpha() for c in t) for t in texts]


def test_language_of_rows_not_learned_from(spark):
    docs = table(spark, SF, "documents")
    model = cross_parsing.fit(docs.where(training_row()))
    odd = spark.createDataFrame([(-1, None, None, "q", "q"), (-2, "", None, "", ""), (-3, "12 .. 5", None, "", ""), (-4, "the and of " * 50_000, "xx", "", "")], DOCS)
    out = {r.doc_id: r for r in cross_parsing.identify(odd.unionByName(docs.select("doc_id", "text", "lang"), allowMissingColumns=True), model).withColumn("held", held_out()).collect()}
    assert [(out[i].lang_pred, out[i].score) for i in (-1, -2, -3)] == [("und", 0.0)] * 3
    assert out[-4].lang_pred == "en" and 0 <= out[-4].score <= 1 and out[-4].language == ""
    held = [r for i, r in out.items() if i >= 0 and r.held]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held) > 20


def test_language_without_a_sample(spark):
    docs = spark.createDataFrame([(1, "text", None, "", "")], DOCS)
    model = cross_parsing.fit(docs)
    assert [(r.lang_pred, r.score) for r in cross_parsing.identify(docs, model).collect()] == [("und", 0.0)]
    assert cross_parsing.identify(docs.limit(0), model).count() == 0


# --- preferences


def test_preferences_equal_their_definition(spark):
    rng = random.Random(7)
    rows = []
    for pair in range(60):
        common = [(t, rng.choice(["user", "assistant", None]), rng.choice(["a", "b", None])) for t in range(rng.randrange(4))]
        for side in rng.choice([("chosen", "rejected"), ("chosen",), ("rejected",)]):
            rest = [(len(common) + t, "assistant", rng.choice("cd")) for t in range(rng.randrange(3))]
            rows += [(pair, side, *t) for t in common + rest]
            rows += [(pair, side, *common[0])] if common and pair % 9 == 0 else []
    rows += [(None, "chosen", 0, "user", "x"), (1000, "other", 0, "user", "x"), (1001, "chosen", None, "user", "n"), (1001, "rejected", None, "user", "n")]
    turns = spark.createDataFrame([(*r, "s", 1) for r in rows], "pair_id long, side string, turn int, role string, text string, segment string, parted int")
    wanted = Counter()
    for pair in {r[0] for r in rows if r[0] is not None}:
        cells = {}
        for p, side, turn, role, text in rows:
            if p == pair and side in ("chosen", "rejected"):
                cells.setdefault(-1 if turn is None else turn, {}).setdefault(side, Counter())[role or "", text or ""] += 1
        parted = min((t for t, c in cells.items() if c.get("chosen") != c.get("rejected")), default=math.inf)
        for t, c in cells.items():
            for side, bag in c.items():
                if t >= parted or side == "chosen":
                    for (role, text), n in bag.items():
                        wanted[pair, side if t >= parted else "prompt", t, role, f"<|im_start|>{role}\n{text}<|im_end|>\n", t >= parted and role == "assistant"] += n
    parts = preferences.preference_turns(turns)
    assert Counter(map(tuple, parts.collect())) == wanted
    for r in preferences.joined(parts).collect():
        for side in ("chosen", "rejected"):
            spans = r[f"{side}_train"] or []
            assert all(r[side][s.start : s.end].startswith("<|im_start|>assistant") and r[side][s.start : s.end].endswith("<|im_end|>\n") for s in spans)
    assert preferences.preference_turns(turns.limit(0)).count() == 0


# --- queries and pipeline


@pytest.mark.parametrize("name", [q for q in QUERIES if q not in ORACLES])
def test_queries_cover_their_tables(spark, name):
    out = QUERIES[name](spark, SF)
    rows = out.collect()
    key = {"op2_adaptive_scan": "vec_id", "op5_zip_warc": "page_id"}.get(name, "doc_id")
    source = {"vec_id": "embeddings", "page_id": "pages"}.get(key, "documents")
    assert {r[key] for r in rows} >= ({r[0] for r in table(spark, SF, source).select(key).collect()} if name[:4] not in ("op1_", "op2_") else set())


def test_pipeline_keeps_and_drops(spark, folder):
    documents = table(spark, SF, "documents")
    benchmark = [r.text for r in table(spark, SF, "benchmark").collect()]
    clean = [r.text for r in documents.where("lang = 'en' and n_chars > 300").limit(6).collect()]
    odd = [
        (9001, "1234 5678", None, None, None),
        (9002, clean[0], "en", "src0", 1),
        (9003, f"{clean[1][:200]} {benchmark[1]} {clean[4][:200]}", "en", "src1", 1),
        (9004, clean[2][:250] + ' token = "zzzz1111yyyy2222" ' + clean[3][:250], None, "src2", 1),
        (None, "and the of was that with this from", None, None, None),
        (9005, None, None, None, None),
    ]
    docs = documents.unionByName(spark.createDataFrame(odd, documents.schema)).unionByName(documents.where("doc_id = 3"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        path = f"{folder}/{name.replace(' ', '-')}"
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = docs.collect()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == documents.columns
    ids = {name: Counter(r.doc_id for r in rows) for name, rows in kept.items()}
    assert not {9001, 9005} & set(ids["language ID"]) and ids["language ID"][3] == 2
    assert 9002 not in ids["MinHash near-dedup"] and ids["MinHash near-dedup"][3] <= 1 and ids["MinHash near-dedup"][None] == 1
    assert 9003 in ids["MinHash near-dedup"] and 9003 not in ids["benchmark decontamination"]
    cut = {r.doc_id: r for r in kept["secret scans"]}
    assert "zzzz1111" not in cut[9004].text and cut[9004].lang == "en" and cut[9004].n_chars == len(cut[9004].text)
    assert ids["secret scans"] == ids["benchmark decontamination"]
    assert set(ids["mixing sources"]) <= set(ids["secret scans"])
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_language_stage_keeps_texts_with_letters(spark):
    schema = table(spark, SF, "documents").schema
    unknown = [(1, "some words", None, None, None), (2, "12 34", None, None, None), (3, None, None, None, None)]
    out = corpus_pipeline.language(spark, spark.createDataFrame(unknown, schema), SF).collect()
    assert [(r.doc_id, r.lang) for r in out] == [(1, None)]  # nothing to learn from
    even = [(i, "alpha beta", f"l{i % 4}", None, None) for i in range(40)]  # all languages tie
    even += [(100, "alpha beta", None, None, None), (101, "12", "l0", None, None)]
    out = corpus_pipeline.language(spark, spark.createDataFrame(even, schema), SF).collect()
    assert sorted((r.doc_id, r.lang) for r in out) == [(i, f"l{i % 4}") for i in range(40)]


def test_language_stage_decides_what_is_drawn(spark):
    rng = random.Random(11)
    words = {name: ["".join(rng.choices(letters, k=rng.randrange(3, 8))) for _ in range(40)] for name, letters in (("xx", "aeioukl"), ("yy", "aeiourst"))}
    written = lambda name, n=80: " ".join(rng.choices(words[name], k=n))
    # texts given as what they are, then held-out ones of yy under other names
    rows = [(i, written(name), name) for i, name in enumerate(["xx"] * 400 + ["yy"] * 200)]
    apart = [i for i in range(10_000, 11_000) if zlib.crc32(str(i).encode()) % 4 == 2]
    rows += [(i, written("yy"), "xx") for i in apart[:12]] + [(i, written("yy"), None) for i in apart[12:15]]
    rows += [(i, written("yy"), "rare") for i in apart[15:17]] + [(i, written("yy", 4), "xx") for i in apart[17:20]]
    schema = table(spark, SF, "documents").schema
    docs = spark.createDataFrame([(i, t, lang, "one", len(t)) for i, t, lang in rows], schema)
    out = corpus_pipeline.language(spark, docs, SF)
    wanted = {i: lang for i, _, lang in rows} | dict.fromkeys(apart[:15], "yy")
    assert {r.doc_id: r.lang for r in out.collect()} == wanted
    assert {r.doc_id: r.text for r in out.collect()} == {i: t for i, t, _ in rows}

    # the languages found are what the mixture draws by: other rows than by the languages given
    drawn = corpus_pipeline.mixture(spark, out, SF).collect()
    tokens, longest = Counter(), max(len(t.split()) for _, t, _ in rows)
    for i, t, _ in rows:
        tokens[wanted[i]] += len(t.split())
    budgets = mixing.solve(tokens, target_entropy=0.95, max_repeats=4.0).budgets
    got = Counter()
    for r in drawn:
        assert r.lang == wanted[r.doc_id]
        got[r.lang] += r.tokens
    assert set(got) == set(budgets) and all(0 <= got[k] - budgets[k] < longest for k in got)
    assert Counter(r.doc_id for r in drawn) != Counter(r.doc_id for r in corpus_pipeline.mixture(spark, docs, SF).collect())


def test_language_stage_keeps_texts_of_two_languages(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    given = {r.doc_id: r.lang for r in docs.collect()}
    out = corpus_pipeline.language(spark, docs, SF).collect()
    # German around a passage in French is not English
    assert {r.doc_id for r in out if r.lang != given[r.doc_id]} == set() and len(out) == len(given)


def test_language_stage_keeps_what_it_cannot_tell(spark):
    rng = random.Random(12)
    words = ["".join(rng.choices("aeioukl", k=rng.randrange(3, 8))) for _ in range(40)]
    schema = table(spark, SF, "documents").schema
    rows = [(i, " ".join(rng.choices(words, k=80)), ("xx", "zz")[i % 2], "one", 1) for i in range(400)]
    model = cross_parsing.fit(spark.createDataFrame(rows, schema).where(training_row()))
    found = cross_parsing.identify(spark.createDataFrame(rows, schema).where(held_out()), model).collect()
    assert any(r.lang != r.lang_pred and r.score >= 0.99 for r in found)
    out = corpus_pipeline.language(spark, spark.createDataFrame(rows, schema), SF).collect()
    assert {r.doc_id: r.lang for r in out} == {i: lang for i, _, lang, *_ in rows}


def test_stages_of_nothing(spark):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, table(spark, SF, "documents").limit(0), SF).count() == 0


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_its_sql(spark, name):
    from tests.oracle import compare, connect

    assert compare(spark, connect(SF), name, QUERIES[name], ORACLES[name], SF) is None
