"""Operators of the text subpackage against brute force, exact round trips and odd rows."""

import hashlib
import os
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from compare import compare, connect
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

import corpus_pipeline
from kerbline.llm import bloom, chain_dedup, chat, components, exact_dedup, importance, jaccard_join, lexicon_bpe, packing, projection_dedup, spans, token_counts, toxicity
from kerbline.llm.queries import QUERIES, SQL
from kerbline.session import settle

ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one two"), (6, "One  TWO three four"), (6, "One  TWO three four"), (None, "one two"),
       (7, "é ß <|endoftext|> don't 12"), (8, "word " * 30_000), (9, "</s>[INST] a\\b"), (10, "a b  c")]


@pytest.fixture(scope="module")
def odd(spark):
    rows = spark.createDataFrame(ODD, "doc_id long, text string")
    return rows.withColumn("kept", F.lit("x")).withColumn("n", F.lit(1)).withColumn("key", F.lit(2))


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("doc_id = -5")


def sets_of(text, k):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if len(words) >= k else frozenset([tuple(words)] if words else [])


def classes(links, nodes):
    above = {x: x for x in nodes}

    def root(x):
        while above[x] != x:
            x = above[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        above[max(a, b)] = min(a, b)
    return {x: root(x) for x in nodes}


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql_twin(spark, folder, name):
    class Query:
        sql = SQL[name]

        def __call__(self, *a):
            return QUERIES[name](*a)

    assert compare(Query(), spark, folder, connect(folder)) is None


@pytest.mark.parametrize(("k", "num", "den"), [(3, 9, 10), (5, 8, 10)])
def test_jaccard_against_all_pairs(spark, folder, k, num, den):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r["doc_id"]: sets_of(r["text"], k) for r in docs.collect()}
    ids = sorted(texts)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if texts[a] and texts[b] and den * len(texts[a] & texts[b]) >= num * len(texts[a] | texts[b])]
    want = {d: (len(texts[d]), c) for d, c in classes(links, ids).items()}
    got = jaccard_join.jaccard_components(docs, jaccard_join.Rule(k, num, den), per_list=3, per_component=2000)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == want


def test_jaccard_odd_rows(odd, none):
    got = jaccard_join.jaccard_components(odd).collect()
    assert len(got) == len(ODD)
    by = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got}
    assert by[1] == (0, 1) and by[3] == (0, 3) and by[5] == (1, 5) and by[6] == (2, 6) and by[None] == (1, None)
    assert jaccard_join.jaccard_components(none).count() == 0


def test_components_of_a_long_path_and_a_hub(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 1001 + i) for i in range(300)]
    got = components.components(spark.createDataFrame(links, "a long, b long").repartition(8), "a", "b")
    want = classes(links, {x for p in links for x in p})
    assert {r["node"]: r["component"] for r in got.collect()} == want


def test_bitmaps_never_miss(spark):
    values = list(range(500)) + list(range(100))
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(5)
    twice, once = bloom.build(df, "v", 1 << 16, twice=True), bloom.build(df, "v", 1 << 16)
    assert bloom.contains(twice, np.arange(100)).all() and bloom.contains(once, np.arange(500)).all()
    assert bloom.contains(twice, np.arange(100, 500)).mean() < 0.2
    assert {r["v"] for r in bloom.drop_rows(df, df.where("v < 400"), "v").collect()} == set(range(400, 500))


def test_exact_dedup_odd_rows(odd, none):
    got = {(r["doc_id"]): (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup.exact_groups(odd).collect()}
    assert got[1] == (1, 2, True) and got[2] == (1, 2, False) and got[5] == (5, 2, True) and got[None] == (5, 2, False) and got[6] == (6, 2, True)
    assert exact_dedup.exact_groups(none).count() == 0
    assert exact_dedup.keep_first(odd).count() == len(ODD) - 1  # 2 goes; the row without an id stays


def test_bpe_equals_the_library(odd, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    own = Tokenizer.from_file(path)
    encoded = lexicon_bpe.encode(odd, path, lexicon_size=8)
    want = sorted((d or 0, own.encode(t or "", add_special_tokens=False).ids) for d, t in ODD)
    assert sorted((r["doc_id"] or 0, list(r["ids"])) for r in encoded.collect()) == want
    texts = sorted((r["doc_id"] or 0, r["decoded"]) for r in lexicon_bpe.decode(encoded, path).collect())
    assert texts == sorted((d or 0, own.decode(own.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False)) for d, t in ODD)
    assert lexicon_bpe.encode(none, path).count() == 0


def test_transducer_shares_suffixes_and_ranks_keys():
    words = [b"tapping", b"topping", b"tap", b"top", b"x"]
    a = lexicon_bpe.compile_transducer({w: [i] for i, w in enumerate(sorted(words))})
    assert len(a["step"]) - 1 < 1 + sum(map(len, words)) / 2 + 2
    table = lexicon_bpe.LexiconTable(open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read(), a)
    data = np.frombuffer(b"".join(sorted(words)) + b"ta", np.uint8)
    stop = np.cumsum([*map(len, sorted(words)), 2])
    first, count, ids = table.known(data, np.concatenate(([0], stop[:-1])), stop)
    assert count.tolist() == [1] * 5 + [-1] and ids[first[:5]].tolist() == list(range(5))


def test_packing_against_the_library(odd, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    own, want = Tokenizer.from_file(path), []
    for d, t in ODD:
        ids = [*own.encode(t or "", add_special_tokens=False).ids, 0]
        want += [(d or 0, p, s, len(ids[s : s + 64]), zlib.crc32(np.array(ids[s : s + 64], "<u4").tobytes())) for p, s in enumerate(range(0, len(ids), 64))]
    rows = packing.pack(odd.repartition(3), path, capacity=64, per_task=4).collect()
    assert sorted((r["doc_id"] or 0, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == sorted(want)
    bins = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == bins.get(r["sequence_id"], 0)
        bins[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(bins.values()) <= 64
    assert packing.pack(none, path).count() == 0


def test_chat_reads_back_what_it_wrote(spark):
    rows = [(1, 0, "system", "be <b>"), (1, 1, "user", "[INST] \\l \\e hi "), (1, 2, "assistant", "</s>x"), (2, 0, "assistant", None), (None, None, None, "q"), (3, 0, "to<ol", "z"), (3, 0, "to<ol", "z")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("segments", F.lit(0))
    whole = chat.assemble(chat.format_turns(turns)).select("conv_id", "valid", chat.read_turns(F.col("formatted")).alias("t"))
    got = {r["conv_id"]: (r["valid"], [(x["role"], x["text"]) for x in r["t"]]) for r in whole.collect()}
    assert got == {
        1: (True, [("system", "be <b>"), ("user", "[INST] \\l \\e hi "), ("assistant", "</s>x")]), 2: (False, [("assistant", "")]),
        None: (False, [("", "q")]), 3: (False, [("to<ol", "z")] * 2),
    }
    assert chat.assemble(chat.format_turns(turns.where("turn > 9"))).count() == 0


def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((40, 16))
    x = np.concatenate([base, base[:10] + 0.1 * rng.standard_normal((10, 16)), np.repeat(base[:1], 30, axis=0)]).astype(np.float32)
    rows = [(i, v.tolist(), "a") for i, v in enumerate(x)] + [(900, None, "b"), (901, [0.0] * 16, "b"), (902, [float("nan")] * 16, "b"), (903, [1.0, None], "b"), (904, [], "b"), (None, [1.0] * 16, "b")]
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("component", T.StringType())])
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in projection_dedup.near_vectors(spark.createDataFrame(rows, schema), window=8, block=16).collect()}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    near = u @ u.T >= 0.9
    label = classes([(i, j) for i, j in zip(*np.nonzero(near), strict=True)], range(len(x)))
    assert {i: got[i] for i in range(len(x))} == {i: (int(near[i].sum()) - 1, label[i], label[i] == i) for i in range(len(x))}
    assert all(got[i] == (0, i, True) for i in range(900, 905)) and got[None] == (0, None, True)


def test_token_files_are_found_again(odd, none, spark, tmp_path):
    import sentencepiece

    model = open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read()
    token_counts.write_token_files(odd.repartition(3), str(tmp_path / "t"), model)
    own = sentencepiece.SentencePieceProcessor(model_proto=model)
    want = sorted(len(own.encode(t or "")) for _, t in ODD)
    for block in (7, 1 << 20):
        rows = token_counts.scan_token_files(spark, str(tmp_path / "t"), block=block).collect()
        assert sorted(r["n_tokens"] for r in rows) == want and all(r["closed"] for r in rows)
        for f in {r["file"] for r in rows}:
            mine = sorted((r["doc_no"], r["start"], r["n_tokens"]) for r in rows if r["file"] == f)
            assert [m[0] for m in mine] == list(range(len(mine))) and all(b[1] == a[1] + a[2] + 1 for a, b in zip(mine, mine[1:], strict=False))
    token_counts.write_token_files(none, str(tmp_path / "n"), model)
    assert token_counts.scan_token_files(spark, str(tmp_path / "n")).count() == 0


@pytest.mark.parametrize("head", [[], [0xBBEF, 0x00BF], [2]])
def test_token_files_are_read_in_blocks(spark, tmp_path, head):
    rnd = np.random.default_rng(3)
    want = []
    for n, (size, tail) in enumerate([(150_000, [2]), (90_000, [7, 9]), (3, [2]), (0, []), (40_000, [])]):
        # 512 and 256 hold the bytes of the separator between them
        ids = rnd.choice([2, 512, 256, 0, 515, 7], size, p=[0.001, 0.2, 0.2, 0.2, 0.2, 0.199])
        if n == 4:
            ids[ids == 2] = 7  # one document, not closed
        ids = np.append(np.append(head, ids) if size else ids, tail).astype("<u2")
        (tmp_path / f"part-{n:05d}.txt").write_bytes(ids.tobytes())
        stops = np.flatnonzero(ids == 2)
        begin = np.append(0, stops + 1)
        want += [(n, i, int(begin[i]), int(e - begin[i]), True) for i, e in enumerate(stops)]
        if begin[-1] < len(ids):
            want.append((n, len(stops), int(begin[-1]), int(len(ids) - begin[-1]), False))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    rows = token_counts.scan_token_files(spark, str(tmp_path), block=1 << 15)
    assert "binaryFile" not in rows._jdf.queryExecution().toString() and spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    got = rows.collect()
    assert sorted((int(r["file"].split("part-")[1][:5]), *list(r)[1:]) for r in got) == sorted(want)
    assert rows.schema.simpleString() == "struct<file:string,doc_no:bigint,start:bigint,n_tokens:bigint,closed:boolean>"


def test_passages_are_found_fuzzy_and_whole(spark, none, odd):
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(5000)]
    text = lambda n: [vocabulary[i] for i in rng.integers(0, 5000, n)]
    passage = text(70)
    fuzzy = [*passage[:30], "new", *passage[30:50], *passage[51:]]
    docs = {1: text(200) + passage + text(100), 2: text(50) + passage + text(300), 3: text(90) + fuzzy, 4: text(400)}
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in docs.items()], "doc_id long, text string")
    found = chain_dedup.repeated_passages(df)
    got = {r["doc_id"]: (r["owner_id"], r["start"], r["stop"]) for r in found.collect()}
    assert got == {2: (1, 50, 120), 3: (1, 90, 160)}
    cut = {r["doc_id"]: r["text"].split() for r in chain_dedup.cut_passages(df, found).collect()}
    assert cut == {1: docs[1], 2: docs[2][:50] + docs[2][120:], 3: docs[3][:90], 4: docs[4]}
    assert chain_dedup.repeated_passages(none).count() == 0 and chain_dedup.cut_passages(odd, chain_dedup.repeated_passages(odd)).count() == len(ODD)


def test_chains_equal_the_plain_recursion():
    rng = np.random.default_rng(11)
    for _ in range(30):
        n = int(rng.integers(1, 14))
        start, other, length = np.sort(rng.integers(0, 60, n)), rng.integers(0, 60, n), rng.integers(1, 8, n)
        score = []
        for j in range(n):
            before = [score[i] - 0.2 * (start[j] - start[i] - length[i] + other[j] - other[i] - length[i]) for i in range(j) if start[i] + length[i] <= start[j] and other[i] + length[i] <= other[j]]
            score.append(length[j] + max([0.0, *before]))
        chain = chain_dedup.best_chains(start, start + length, other, other + length, 0.2)[0]
        got = sum(length[chain]) - sum(0.2 * (start[b] - start[a] - length[a] + other[b] - other[a] - length[a]) for a, b in zip(chain, chain[1:], strict=False))
        assert abs(got - max(score)) < 1e-9


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_equals_edit_distance():
    rng = np.random.default_rng(2)
    terms, stems = [b"trash", b"pathetic", b"disgusting", b"scum"], [b"lowe"]
    machine = toxicity.compile_terms(terms, stems)
    words = [b"lowering", b"low", b"scum", b"scun", b""]
    for term in terms:
        for _ in range(60):
            w = bytearray(term)
            for _ in range(int(rng.integers(0, 4))):
                at = int(rng.integers(0, len(w) + 1))
                w[at : at + int(rng.integers(0, 2))] = bytes(rng.choice([97, 114, 120], int(rng.integers(0, 2))).tolist())
            words.append(bytes(w))
    stop = np.cumsum([len(w) for w in words])
    term, kind = machine.read(np.frombuffer(b"".join(words), np.uint8), np.concatenate(([0], stop[:-1])), stop)
    for w, t, k in zip(words, term, kind, strict=True):
        near = {i: distance(w, x) for i, x in enumerate(terms) if distance(w, x) <= toxicity.edits_for(x)}
        want = toxicity.EXACT if 0 in near.values() else toxicity.TYPO if near else toxicity.STEM if w.startswith(b"lowe") else -1
        assert k == want and (k < 0 or k == toxicity.STEM or near[int(t)] == min(near.values()))


def test_toxicity_held_out_and_odd_rows(spark, odd, none):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    rows = QUERIES["op9_toxicity"](spark, folder).where("held_out").join(labels, "doc_id").collect()
    right = sum(r["predicted"] == r["toxic"] for r in rows) / len(rows)
    caught = [r["predicted"] for r in rows if r["toxic"]]
    assert right > 0.97 and sum(caught) / len(caught) > 0.9
    empty = labels.where("doc_id < 0")
    assert all(r["score"] < 1e-12 for r in toxicity.score_toxicity(odd, empty).collect())
    assert toxicity.score_toxicity(odd, labels).count() == len(ODD) and toxicity.score_toxicity(none, labels).count() == 0


def test_importance_rejects_junk_and_repeats_itself(spark, folder, odd, none):
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = importance.score_documents(docs, labels).join(labels, "doc_id").collect()
    assert sum(r["kept"] == (r["quality"] > 0) for r in rows) / len(rows) > 0.97
    assert importance.score_documents(odd, labels).count() == len(ODD) and importance.score_documents(none, labels).count() == 0
    values = spark.createDataFrame([(float(v),) for v in [5, 1, 1, 9, -3, 7, 7]], "v double")
    assert [importance.kth_largest(values, "v", k) for k in range(1, 8)] == [9, 7, 7, 5, 1, 1, -3]


def test_pipeline_decisions(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, before = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, folder)
        rows = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert docs.columns == columns and set(rows) <= set(before), name
        before = rows
    plain = [hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest() for t in before.values()]
    assert len(plain) == len(set(plain))


def test_spans_encode_as_the_whole_text():
    path = public_tokenizers.path("byte_bpe_50k.json")
    own = Tokenizer.from_file(path)
    for text in ("  a  b\n\nc ", "\t", "don't <|endoftext|> x", "é  ü  "):
        data = np.frombuffer(text.encode(), np.uint8)
        start, stop, _ = lexicon_bpe.spaced_spans(data, np.array([0, len(data)]))
        ids, _ = spans.SpanTable(open(path, encoding="utf-8").read()).encode(data, start, stop, lexicon_bpe.span_hashes(data, start, stop))
        assert ids.tolist() == own.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("alike", [0.8, 0.85, 0.9, 0.95])
def test_passages_at_the_stated_similarity(spark, alike):
    """Substitutions at random places and evenly spread; every planted passage is found."""
    rng = np.random.default_rng(int(100 * alike))
    text = lambda n: [f"w{i}" for i in rng.integers(0, 200_000, n)]
    docs, want = {}, {}
    for i in range(60):
        n = (60, 100, 200)[i % 3]
        passage = text(n)
        copy = list(passage)
        changed = round((1 - alike) * n)
        places = np.linspace(0, n - 1, changed + 2)[1:-1].round().astype(int) if i % 2 else rng.choice(np.arange(1, n - 1), changed, replace=False)
        for p in places:
            copy[p] = "x" + copy[p]
        docs[i] = text(80) + passage + text(80)
        docs[100 + i] = text(70) + copy + text(40)
        want[100 + i] = (i, n)
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in docs.items()], "doc_id long, text string")
    covered: dict = {}
    for r in chain_dedup.repeated_passages(df).collect():
        assert want[r["doc_id"]][0] == r["owner_id"]
        assert r["matches"] >= 0.8 * max(r["stop"] - r["start"], r["owner_stop"] - r["owner_start"]) - 1e-9
        covered[r["doc_id"]] = covered.get(r["doc_id"], 0) + r["stop"] - r["start"]
    assert covered.keys() == want.keys()
    assert np.mean([covered[i] / n for i, (_, n) in want.items()]) > 0.85


def test_hits_and_chains_are_deleted_once_they_are_used(spark, monkeypatch):
    written = {}

    def noted(df):
        out = settle(df)
        written[tuple(out.columns)] = [f.removeprefix("file://") for f in out.inputFiles()]
        return out

    monkeypatch.setattr(chain_dedup, "settle", noted)
    line = " ".join(f"w{i}" for i in range(70))
    df = spark.createDataFrame([(i, f"a{i} {line} b{i}") for i in range(3)], "doc_id long, text string")
    found = chain_dedup.repeated_passages(df)
    gone = [files for columns, files in written.items() if "other" in columns or "chain" in columns]
    assert len(gone) == 2 and all(gone) and not any(os.path.exists(f) for files in gone for f in files)
    assert {(r["doc_id"], r["start"], r["stop"]) for r in found.collect()} == {(1, 1, 71), (2, 1, 71)}


def test_passages_whose_parts_stand_in_earlier_documents(spark):
    """Word-for-word copies of 60 words of which every sentence, or overlapping halves, are in earlier documents."""
    rng = np.random.default_rng(8)
    text = lambda n: [f"w{i}" for i in rng.integers(0, 200_000, n)]
    docs, want = {}, {}
    for i in range(40):
        sentences, at = [text(20) for _ in range(3)], 10 * i
        passage = sum(sentences, [])
        parts = [passage[:45], passage[15:]] if i % 2 else sentences
        for j, part in enumerate(parts):
            docs[at + j] = text(30) + part + text(30)
        docs[1000 + i] = text(60) + passage + text(60)
        docs[2000 + i] = text(70) + passage + text(50)
        want[2000 + i] = (1000 + i, 70, 130)
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in docs.items()], "doc_id long, text string")
    got = {r["doc_id"]: (r["owner_id"], r["start"], r["stop"]) for r in chain_dedup.repeated_passages(df).collect()}
    assert got == want


@pytest.mark.parametrize("places", [20_000, 8])
def test_passages_of_seeds_that_many_documents_hold(spark, monkeypatch, places):
    """Copies with differing words of an earlier document, each sentence of which stands in many documents before and after that one."""
    monkeypatch.setattr(chain_dedup, "PLACES", places)
    rng = np.random.default_rng(23)
    text = lambda n: [f"w{i}" for i in rng.integers(0, 200_000, n)]
    docs, want = {}, {}
    for i in range(3):
        sentences = [text(20) for _ in range(3)]
        passage = sum(sentences, [])
        near = ["x" + w if j % 10 == 4 else w for j, w in enumerate(passage)]
        for j in range(12 * 3):
            docs[100 * i + j] = text(30) + sentences[j % 3] + text(30)
            docs[2000 + 100 * i + j] = text(30) + sentences[j % 3] + text(30)
        docs[1000 + i] = text(60) + near + text(60)
        docs[5000 + i] = text(70) + passage + text(50)
        docs[6000 + i] = docs[5000 + i]
        want |= {5000 + i: [(1000 + i, 70, 130)], 6000 + i: [(5000 + i, 0, 180)]}
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in docs.items()], "doc_id long, text string")
    got: dict = {}
    for r in chain_dedup.repeated_passages(df).collect():
        got.setdefault(r["doc_id"], []).append((r["owner_id"], r["start"], r["stop"]))
    assert got == want


def test_vectors_of_a_table_much_larger_than_the_window(spark):
    """Isolated pairs just above the threshold, each window a small share of the rows."""
    rng = np.random.default_rng(17)
    n, dim = 400, 64
    a, b = rng.standard_normal((2, n, dim))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b -= (a * b).sum(axis=1)[:, None] * a
    b = 0.905 * a + np.sqrt(1 - 0.905**2) * b / np.linalg.norm(b, axis=1)[:, None]
    x = np.concatenate([a, b, rng.standard_normal((3200, dim))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["n_links"] for r in projection_dedup.near_vectors(df, window=8).collect()}
    assert sum(got[i] for i in range(n)) >= 0.99 * n
    assert [projection_dedup.passes_for(rows, 0.9, 512, 0.001) for rows in (100, 20_000, 1_000_000)] == [1, 12, 35]


def test_packing_meets_the_bins_of_all_tasks(spark):
    """Short documents in many tasks, few items to a task: no two sequences are left that fit in one."""
    path = public_tokenizers.path("word_bpe_49k.json")
    df = spark.createDataFrame([(i, "one " * (36 if i % 8 else 10)) for i in range(400)], "doc_id long, text string").repartition(40)
    fill = {}
    for r in packing.pack(df, path, capacity=64, per_task=2).collect():
        fill[r["sequence_id"]] = fill.get(r["sequence_id"], 0) + r["length"]
    small = sorted(fill.values())
    assert small[0] + small[1] > 64


def test_toxic_terms_are_bounded_by_evidence_alone(spark):
    """150 telling words, three letters long some of them, each in its own documents."""
    letters = "bcdfghjklm"
    terms = [a + b + c for a in letters[:5] for b in letters for c in letters[:2]] + [f"{a}{b}{c}oquxz" for a in "pqrst" for b in "pqrst" for c in "vw"]
    rows, labels = [], []
    for i, term in enumerate(terms):
        for j in range(8):
            rows += [(16 * i + 2 * j, f"plain words and {term} again"), (16 * i + 2 * j + 1, "plain words and nothing again")]
            labels += [(16 * i + 2 * j, 1), (16 * i + 2 * j + 1, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    ids, flag = np.array([i for i, _ in labels]), np.array([t for _, t in labels])
    assert set(terms) <= set(toxicity.learn_lexicon(df, ids, flag).terms) | {t for t in terms if len(t) > 3}


def test_portions_of_terms_read_as_one_automaton():
    rng = np.random.default_rng(4)
    word = lambda: bytes(rng.integers(97, 101, rng.integers(3, 10)).astype(np.uint8))
    terms, stems = list(dict.fromkeys(word() for _ in range(40))), [b"abca", b"ddcb"]
    data = [word() for _ in range(2000)] + terms
    ends = np.cumsum([len(w) for w in data])
    raw, starts = np.frombuffer(b"".join(data), np.uint8), np.append(0, ends[:-1])
    for a, b in zip(toxicity.compile_terms(terms, stems).read(raw, starts, ends), toxicity.compile_portions(terms, stems).read(raw, starts, ends), strict=True):
        assert (a == b).all()
