"""Tokens, secrets, languages, toxicity and decontamination: exact round trips, held-out rows, brute force, edges."""

import base64
import hashlib
import json
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortforge.llm import decontaminate, language_id, secret_scan, sentencepiece_bpe, toxicity
from cohortforge.llm.queries import fold_of, op3_toxicity, op4_sentencepiece, op7_secret_scan, op8_language_id, tokenizer_path


@pytest.fixture(scope="module")
def library():
    sentencepiece = pytest.importorskip("sentencepiece")
    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())


def test_tokens_equal_the_library(library):
    rng = random.Random(5)
    parts = ["a", "b", " ", "  ", "▁", "é", "日", "😀", "\t", "\n", "th", "the", "ing", "aaaa", "\xa0", "ß", "x" * 9, "ab" * 7, "<s>", "<0x41>", "\0", "�"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    texts += [" " * k for k in range(70)] + ["ab" * 3000, "a" * 9000, "".join(rng.choice("abcdef0123+/") for _ in range(9000))]
    coder = sentencepiece_bpe.Encoder(sentencepiece_bpe.load_pieces(tokenizer_path()))
    ids = coder.encode(texts)
    assert [i.tolist() for i in ids] == library.encode(texts)
    assert coder.decode(ids) == [library.decode(i.tolist()) for i in ids]


def test_token_query(spark, data, library):
    got = {r["doc_id"]: r for r in op4_sentencepiece(spark, data).collect()}
    rows = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for i, t in rows:
        ids = library.encode(t or "")
        want = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())
        assert (got[i]["n_tokens"], got[i]["ids_sha256"], got[i]["decoded_sha256"]) == want


def test_token_edges(odd_docs, library):
    rows = sentencepiece_bpe.decode(sentencepiece_bpe.encode(odd_docs, tokenizer_path()), tokenizer_path()).collect()
    assert all(r["ids"] == library.encode(r["row"]["text"] or "") and r["decoded"] == (r["row"]["text"] or "") for r in rows)
    assert sentencepiece_bpe.encode(odd_docs.limit(0), tokenizer_path()).count() == 0


def der(tag, body):
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x80 | (n.bit_length() + 7) // 8]) + n.to_bytes((n.bit_length() + 7) // 8, "big")
    return bytes([tag]) + size + body


def keys():
    rng = random.Random(7)
    rsa = der(0x30, b"".join(der(2, b"\x01" + rng.randbytes(n)) for n in (0, 128, 2, 128, 64, 64, 64, 64, 64)))
    pkcs8 = der(0x30, der(2, b"\0") + der(0x30, der(6, b"\x2a\x86\x48\x86\xf7") + der(5, b"")) + der(4, rsa))
    field = lambda b: len(b).to_bytes(4, "big") + b
    ssh = field(b"ssh-rsa") + field(b"\1\0\1") + field(rng.randbytes(129))
    return rsa, pkcs8, ssh


def test_structures_are_confirmed():
    rsa, pkcs8, ssh = keys()
    assert secret_scan.is_der_key(rsa) and secret_scan.is_der_key(pkcs8) and secret_scan.is_ssh_key(ssh)
    for bad in (rsa[:-1], rsa + b"\0", b"\x30" + rsa[1:2] + rsa[3:], random.Random(1).randbytes(300)):
        assert not secret_scan.is_der_key(bad)
    assert not secret_scan.is_ssh_key(ssh[:-1])
    head = base64.urlsafe_b64encode(json.dumps({"alg": "HS256", "typ": "JWT"}).encode()).decode().rstrip("=")
    fake = base64.urlsafe_b64encode(json.dumps({"typ": "none at all"}).encode()).decode().rstrip("=")
    b64 = base64.b64encode(pkcs8).decode()
    pem = "-----BEGIN PRIVATE KEY-----\n" + "\n".join(b64[i : i + 64] for i in range(0, len(b64), 64)) + "\n-----END PRIVATE KEY-----\n"
    text = f"é {head}.eyJzdWIiOiIxIn0.c2lnbmF0dXJl and {fake}.eyJzdWIiOiIxIn0.c2ln\n{pem}\n{base64.b64encode(ssh).decode()} end {rsa.hex()} {'ab' * 40}"
    kinds = Counter(k for k, _, _ in secret_scan.find_spans(text))
    assert kinds == {"jwt": 1, "der": 2, "ssh": 1, "hex": 2}
    for kind, a, b in secret_scan.find_spans(text):
        if kind == "ssh":
            assert text[a:b] == base64.b64encode(ssh).decode()


def test_secret_query_keeps_the_base_spans(spark, data):
    patterns = (("assign", re.compile(secret_scan.ASSIGN, re.ASCII), lambda m: len(m[2]) >= 6), ("access", re.compile(secret_scan.ACCESS), lambda m: len(m[0]) >= 20), ("hex", re.compile(secret_scan.HEX), lambda m: len(m[0]) >= 24))
    got = {r["doc_id"]: r for r in op7_secret_scan(spark, data).collect()}
    for i, t in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect():
        spans = [(m.start(), n, k, m.end()) for n, (k, p, ok) in enumerate(patterns) for m in p.finditer(t or "") if ok(m)]
        said = ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(spans))
        assert got[i]["base_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert (got[i]["n_assign"], got[i]["n_access"], got[i]["n_hex"]) == tuple(sum(s[2] == k for s in spans) for k in ("assign", "access", "hex"))


def test_secret_edges(odd_docs, make_docs):
    assert all(r["spans"] == [] for r in secret_scan.scan(odd_docs).collect())
    assert secret_scan.scan(odd_docs.limit(0)).count() == 0
    rows = secret_scan.scan(make_docs([(1, "TOKEN = 'abcdef' paſſword=abcdefgh")])).collect()
    assert [(s["kind"], s["start"], s["end"]) for s in rows[0]["spans"]] == [("assign", 0, 15)]


def direct_bits(counts, text):
    """Code length by the definition, byte by byte."""
    data, bits = b"\0" * 3 + text.lower().encode(), 0.0
    from math import log2

    for p in range(3, len(data)):
        for k in (3, 2, 1, 0):
            here = counts[k].get(data[p - k : p], {})
            if not here:
                continue
            n, kinds = sum(here.values()), len(here)
            if data[p] in here:
                bits += log2((n + kinds) / here[data[p]])
                break
            bits += log2((n + kinds) / kinds)
        else:
            bits += 8
    return bits


def test_language_code_lengths_are_exact(spark):
    texts = {"en": ["the cat sat on the mat.", "a dog and a cat"], "de": ["der hund und die katze", "ein haus am see, größer"]}
    trees = language_id.fit(spark.createDataFrame([(k, t) for k, v in texts.items() for t in v], "lang string, text string"))
    tests = ["the cat", "der hund", "größe xyz Ω", "", "a" * 50, "zq7"]
    got = language_id.code_lengths(trees, tests)
    for column, lang in enumerate(trees.langs):
        counts = [{} for _ in range(4)]
        for t in texts[lang]:
            data = b"\0" * 3 + t.lower().encode()
            for p in range(3, len(data)):
                for k in range(4):
                    here = counts[k].setdefault(data[p - k : p], {})
                    here[data[p]] = here.get(data[p], 0) + 1
        for row, t in enumerate(tests):
            assert got[row, column] == pytest.approx(direct_bits(counts, t), abs=1e-3)


def test_language_chunks_do_not_change_lengths(spark, monkeypatch):
    rows = [("en", "the cat sat on the mat " * 20), ("fr", "le chat est sur la table " * 20)]
    trees = language_id.fit(spark.createDataFrame(rows, "lang string, text string"))
    texts = ["the table est " * 30, "x", "", "chat " * 100]
    whole = language_id.code_lengths(trees, texts)
    monkeypatch.setattr(language_id, "CHUNK", 64)
    assert language_id.code_lengths(trees, texts) == pytest.approx(whole, abs=1e-3)


def test_language_held_out_and_edges(spark, data, odd_docs):
    big = data.replace("sf0.001", "sf0.01")
    truth = spark.read.parquet(f"{big}/documents.parquet").select("doc_id", "lang")
    right = op8_language_id(spark, big).where("held_out").join(truth, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97
    docs = odd_docs.select("doc_id", F.lit(False).alias("held_out"), "text", "lang")
    none = language_id.fit(language_id.sample_rows(docs, 10))
    assert {r["lang_pred"] for r in language_id.predict(docs, none).collect()} == {"und"}
    some = language_id.fit(spark.createDataFrame([("en", "one two")], "lang string, text string"))
    by = [(r["doc_id"], r["lang_pred"]) for r in language_id.predict(docs, some).collect()]
    assert {p for i, p in by if i in (1, 2, 3)} == {"und"} and {p for i, p in by if i in (None, 4, 5, 6)} == {"en"}


CLEAN = "the weather is fine and we walk along the river to the old mill every day of spring".split()


@pytest.fixture(scope="module")
def insult_model():
    rng = random.Random(2)
    sentence = lambda *more: " ".join(rng.sample(CLEAN, 9) + list(more)) + "."
    insults = ["blockhead", "nincompoop", "scoundrel", "dimwitted"]
    texts = [" ".join(sentence() for _ in range(4)) for _ in range(150)]
    bad = [" ".join([sentence(), sentence(rng.choice(insults)), sentence(rng.choice(insults))]) for _ in range(80)]
    return toxicity.fit(texts + bad, [0] * len(texts) + [1] * len(bad), landmarks=64)


def test_toxicity_tolerates_gaps_and_insertions(insult_model, spark):
    clean = " ".join(CLEAN) + ". The mill is old."
    variants = ["blockhead", "b l o c k h e a d", "b.l.o.c.k.h.e.a.d", "block*head", "bloxckhead", "SCOUNDREL!!", "nincom-poop", "dimwittxed"]
    rows = [(i, f"{clean} You are a {v}. {clean}") for i, v in enumerate(variants)] + [(100, clean), (101, None), (102, ""), (103, "the river " * 5000)]
    got = {r["doc_id"]: r for r in toxicity.score_texts(spark.createDataFrame(rows, "doc_id long, text string"), insult_model).collect()}
    assert [v for i, v in enumerate(variants) if not got[i]["predicted"]] == []
    assert not any(got[i]["predicted"] for i in (100, 101, 102, 103))
    kept = toxicity.score_texts(spark.createDataFrame(rows, "doc_id long, text string"), insult_model, keep_only_clean=True)
    assert sorted(r["doc_id"] for r in kept.collect()) == [100, 101, 102, 103]


def test_folded_weights_equal_the_landmark_expansion(insult_model):
    words = toxicity.pieces("blockhead") + toxicity.pieces("river")
    scorer = toxicity.Scorer(insult_model)
    dense = {}
    for w in words:
        total = 0.0
        of, lengths = toxicity.word_of([w])
        for k, _, weight in toxicity.subsequences([w]):
            place = {key: x for key, x in zip(insult_model.keys.tolist(), insult_model.weights.tolist())}
            total += sum(place.get(x, 0.0) * weight for x in k.tolist())
        dense[w] = total / toxicity.NORM_OF[len(w)] + insult_model.bias
    assert scorer.framed(words) == pytest.approx([dense[w] for w in words], abs=1e-4)


def test_scorer_table_holds_the_blocks_with_weights_only(insult_model):
    scorer = toxicity.Scorer(insult_model)
    assert scorer.table.nbytes < 16 << 20  # one cell for every key there could be takes 64 MB
    keys = np.concatenate([insult_model.keys, np.random.default_rng(3).integers(0, 1 << 24, 10_000)])
    weight = dict(zip(insult_model.keys.tolist(), insult_model.weights.tolist()))
    assert scorer.table[scorer.places(keys)].tolist() == [weight.get(k, 0.0) for k in keys.tolist()]


def test_fit_takes_few_bytes_a_word():
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(40_000)]
    texts = [". ".join(" ".join(rng.choices(words, k=8)) for _ in range(25)) + (" blockhead" if i % 2 else "") for i in range(1000)]
    tracemalloc.start()
    model = toxicity.fit(texts, [i % 2 for i in range(1000)], landmarks=16)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert model.curve is not None
    assert most < 45e6  # 200,000 words, 40,000 of them different


def test_toxicity_edges(odd_docs, spark):
    assert toxicity.fit(["a", "b"], [1, 1]).curve is None
    rows = toxicity.score_texts(odd_docs, toxicity.Model()).collect()
    assert len(rows) == odd_docs.count() and all(r["score"] == 0 and r["predicted"] == 0 for r in rows)
    labels = spark.createDataFrame([(4, 1), (4, 0), (None, 1), (5, None), (6, 7)], "doc_id long, toxic int")
    got = sorted((r["text"], r["toxic"]) for r in toxicity.sample_rows(odd_docs, labels, 10).collect())
    assert got == [("one", 0), ("one", 0), ("one", 1), ("one", 1)]


def test_toxicity_held_out(spark, data):
    big = data.replace("sf0.001", "sf0.1")
    labels = spark.read.parquet(f"{big}/labels.parquet").select("doc_id", "toxic")
    rows = op3_toxicity(spark, big).join(labels, "doc_id").where("held_out").toPandas()
    hit, said, there = ((rows.predicted == 1) & (rows.toxic == 1)).sum(), (rows.predicted == 1).sum(), (rows.toxic == 1).sum()
    assert hit / there > 0.88 and hit / said > 0.9


def bm25_by_definition(passage, items):
    words = [decontaminate.words_of(t.casefold()) for _, t in items]
    mean, df = sum(map(len, words)) / len(words), Counter(w for x in words for w in set(x))
    from math import log

    def score(terms, x):
        tf = Counter(x)
        return sum(log(1 + (len(items) - df[t] + 0.5) / (df[t] + 0.5)) * tf[t] * 2.2 / (tf[t] + 1.2 * (0.25 + 0.75 * len(x) / mean)) for t in terms if tf[t])

    return [score(set(passage), x) / score(set(x), x) for x in words]


@pytest.fixture(scope="module")
def items(spark):
    rng = random.Random(9)
    words = [f"{a}{b}" for a in "ba ce di fo gu ha".split() for b in "len mor tip sar".split()]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(6, 25))) + ". " + " ".join(rng.choice(words) for _ in range(rng.randint(1, 6))) + ".") for i in range(60)]
    return rows, words


def test_wand_finds_all_above_the_share(spark, items):
    rows, words = items
    (part,) = list(decontaminate.index_parts(spark.createDataFrame(rows, "item_id long, text string")))
    rng = random.Random(4)
    by_id = {i: n for n, (i, _) in enumerate(rows)}
    for _ in range(60):
        passage = [rng.choice(words) for _ in range(rng.randint(1, 40))]
        want = bm25_by_definition(passage, rows)
        terms = sorted({part.terms[w] for w in passage if w in part.terms})
        for share in (0.05, 0.3, 0.6, 0.9):
            got = {part.items[k]: x for k, x in decontaminate.block_max_wand(terms, part, share)}
            assert set(got) == {i for i, n in by_id.items() if want[n] >= share - 1e-9}
            assert all(x == pytest.approx(want[by_id[i]], abs=1e-6) for i, x in got.items())


def test_contaminated_texts(spark, items, make_docs, odd_docs):
    rows, _ = items
    table = spark.createDataFrame(rows, "item_id long, text string")
    filler = "nothing of it stands here, only other text. " * 40
    longest = max(rows, key=lambda r: len(r[1]))
    docs = [(1, filler + longest[1] + filler), (2, filler + longest[1].upper().replace(" ", "!! ") + filler), (3, filler), (4, longest[1].partition(". ")[2]), (5, None), (6, "")]
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(make_docs(docs), table).collect()}
    assert got == {(1, longest[0]), (2, longest[0])}
    kept = decontaminate.drop_contaminated(make_docs(docs), table)
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5, 6] and kept.columns == make_docs(docs).columns
    assert decontaminate.contaminated(odd_docs, table).count() == 0
    none = spark.createDataFrame([(None, "x y z"), (1, None), (2, "")], "item_id long, text string")
    assert decontaminate.contaminated(odd_docs, none).count() == 0 and decontaminate.drop_contaminated(odd_docs, none).count() == odd_docs.count()


def test_shards_change_nothing(spark, items, make_docs, monkeypatch):
    rows, _ = items
    table = spark.createDataFrame(rows, "item_id long, text string")
    docs = make_docs([(i, f"some words before. {t} and after") for i, t in rows])
    whole = {tuple(r) for r in decontaminate.contaminated(docs, table).collect()}
    monkeypatch.setattr(decontaminate, "SHARD", 200)
    assert len(list(decontaminate.index_parts(table))) > 1
    assert {tuple(r) for r in decontaminate.contaminated(docs, table).collect()} == whole and len(whole) >= len(rows)


def test_every_copied_item_is_found(spark, data):
    big = data.replace("sf0.001", "sf0.01")
    from cohortforge.llm.queries import op2_decontaminate

    got = {(r["doc_id"], r["item_id"]) for r in op2_decontaminate(spark, big).collect()}
    items = spark.read.parquet(f"{big}/benchmark.parquet").toPandas()
    docs = spark.read.parquet(f"{big}/documents.parquet").select("doc_id", "text").toPandas()
    want = {(d, i) for d, t in zip(docs.doc_id, docs.text.str.casefold()) for i, x in zip(items.item_id, items.text.str.casefold()) if x in t}
    assert want <= got and len(got - want) <= len(want) // 10


def test_fold_is_crc32(spark):
    import zlib

    rows = spark.range(200).select("id", fold_of(F.col("id")).alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["id"]).encode()) % 4 for r in rows)


def test_items_of_one_or_two_words_are_confirmed_by_a_copy(spark, make_docs):
    items = spark.createDataFrame([(1, "Zanzibar"), (2, "quokka marsupial"), (3, "Is it so? Yes")], "item_id long, text string")
    docs = [(1, "They went to Zanzibar in spring"), (2, "the quokka marsupial is small"), (3, "a quokka alone"), (4, "nothing of this")]
    assert sorted((r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(make_docs(docs), items).collect()) == [(1, 1), (2, 2)]
    assert sorted(r["doc_id"] for r in decontaminate.drop_contaminated(make_docs(docs), items).collect()) == [3, 4]


def _der(tag, body):
    size = len(body).to_bytes(2, "big")
    return bytes([tag, 0x82]) + size + body if len(body) > 255 else bytes([tag, 0x81, len(body)]) + body if len(body) > 127 else bytes([tag, len(body)]) + body


@pytest.mark.parametrize("wrap", [
    lambda lines: "\n".join(lines), lambda lines: "key:\n" + "\n".join("    " + x for x in lines) + "\n  next: 1",
    lambda lines: '"key": "' + "\\n".join(lines) + '\\n-----END', lambda lines: "\r\n".join(lines) + "\r\nthat was the key",
    lambda lines: "\n".join(lines) + "\nplain words follow",
])
@pytest.mark.parametrize("encrypted", [False, True])
def test_wrapped_keys_are_found(wrap, encrypted):
    algorithm = _der(0x30, _der(6, b"\x2a\x86\x48\x86\xf7\x0d\x01\x05\x0d") + _der(5, b""))
    body = bytes(range(7, 250)) * 2
    key = _der(0x30, algorithm + _der(4, body)) if encrypted else _der(0x30, _der(2, b"\0") + algorithm + _der(4, body))
    coded = base64.b64encode(key).decode().rstrip("=")
    text = wrap([coded[i : i + 64] for i in range(0, len(coded), 64)])
    (span,) = [s for s in secret_scan.find_spans(text) if s[0] == "der"]
    assert text[span[1] :].startswith(coded[:64]) and text[: span[2]].endswith(coded[-3:])
