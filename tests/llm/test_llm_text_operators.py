"""BPE, packing, language ID and license scans."""
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF001, SF01
from llm_cases import edge_docs, no_docs  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.llm import bpe, langid, licenses, packing, wordbpe
from ledgerline.llm.wordbpe import WordBpe

PATH = bpe.tokenizer_path()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def as_bytes(ids):
    return np.array(ids, "<u4").tobytes()


def test_backtracking_equals_the_library(library):
    own, rng = WordBpe(PATH), random.Random(3)
    texts = [t.replace("</w>", "") for t in library.get_vocab()]
    letters = "abcdeintho'srm.,!<|>/w \u00e9-\u00c9 12\u01c5\u0130\u03a3\u03c3\x1c\x85\u3000\u4f60"
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += [f"ab{chr(c)}cd 1{chr(c)}s" for c in range(0x2000) if not 0xd800 <= c < 0xe000]
    texts += ["a" * 3000, "th" * 2000 + "e", "x<|startoftext|>'s <|ENDOFTEXT|>", "<|endoftext|>" * 2]
    for t in texts:
        want = library.encode(t, add_special_tokens=False).ids
        assert own.encode(t) == as_bytes(want), t
        assert own.decode(as_bytes(want)).decode() == library.decode(want, skip_special_tokens=False), t


@pytest.mark.parametrize("which", ["edge", "none", "sf0.001"])
def test_bpe_digests(spark, edge_docs, no_docs, library, which):
    docs = {"edge": edge_docs, "none": no_docs}.get(which) or spark.read.parquet(f"{SF001}/documents.parquet")
    want = []
    for r in docs.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((r["doc_id"], len(ids), hashlib.sha256(as_bytes(ids)).hexdigest(),
                     hashlib.sha256(text.encode()).hexdigest()))
    assert Counter(map(tuple, bpe.bpe_digests(docs).collect())) == Counter(want)
    apart, at_once = bpe.decode_documents(bpe.encode_documents(docs)), bpe.round_trip(docs)
    assert Counter(map(tuple, apart.collect())) == Counter(map(tuple, at_once.collect()))


@pytest.mark.parametrize("which", ["edge", "none", "sf0.01"])
def test_packing_is_whole_and_tight(spark, edge_docs, no_docs, library, which):
    docs = {"edge": edge_docs, "none": no_docs}.get(which) or spark.read.parquet(f"{SF01}/documents.parquet")
    rows = packing.pack_documents(docs).collect()
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r["length"] > 0
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append(r)
    padding = total = 0
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= packing.MAX_TOKENS and len(parts) <= packing.MAX_SEGMENTS
        total += end
        padding += 0 if end & (end - 1) == 0 else packing.MAX_TOKENS - end
    assert padding <= 0.01 * total
    texts = defaultdict(list)
    for r in docs.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids + [1]
        texts[r["doc_id"]].append(ids)
    assert set(texts) == set(pieces)
    for key, many in texts.items():
        if len(many) == 1:
            ids, at = many[0], 0
            for r in sorted(pieces[key], key=lambda r: r["start"]):
                assert r["start"] == at and r["doc_tokens"] == len(ids)
                assert r["ids_crc32"] == zlib.crc32(as_bytes(ids[at:at + r["length"]]))
                at += r["length"]
            assert at == len(ids)
        else:
            assert sum(r["length"] for r in pieces[key]) == sum(map(len, many))


def test_examples_keep_all_three_limits(spark):
    rng = random.Random(1)
    rows = [(n, t := rng.randrange(1, 900), rng.randrange(0, t + 1)) for n in range(3000)]
    rows += [(5000, 3000, 10), (5001, 100, None), (None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, tokens long, loss long")
    out = packing.pack_examples(df, "conv_id", "tokens", "loss", 2048, 6, 900).collect()
    assert Counter(r["id"] for r in out) == Counter(r[0] for r in rows)
    by = defaultdict(list)
    for r in out:
        by[r["sequence_id"]].append(r)
    for parts in by.values():
        if parts[0]["oversize"]:
            assert len(parts) == 1 and (parts[0]["n_tokens"] > 2048 or parts[0]["n_loss"] > 900)
            continue
        assert sum(r["n_tokens"] for r in parts) <= 2048 and len(parts) <= 6
        assert sum(r["n_loss"] for r in parts) <= 900


def test_dot_product_choice():
    packer = packing.DotProductPacker(10, 4, 10, cut=False)
    for name, tokens, loss in [("a", 6, 0), ("b", 5, 5), ("c", 4, 4), ("d", 2, 9)]:
        packer.add(name, 0, tokens, loss)
    # Demand . room at the start: a .6, b 1.0, c .8, d 1.1 (plus 1/4 each): d, then only what fits beside it.
    assert [p[0] for p in packer.sequence()] == ["d", "a"]
    assert [p[0] for p in packer.sequence()] == ["b", "c"]


def test_language_id(spark, edge_docs, no_docs):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    out = langid.language_id(docs).collect()
    assert len(out) == len(truth)
    for r in out:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1
    judged = [r["lang_pred"] == truth[r["doc_id"]] for r in out if r["held_out"] and truth[r["doc_id"]]]
    assert sum(judged) / len(judged) > 0.95
    edge = langid.language_id(edge_docs).collect()
    assert len(edge) == edge_docs.count()
    assert all((r["lang_pred"], r["score"]) == ("und", 0.0) for r in edge if r["doc_id"] in (2, 3, 4, 5))
    assert all(r["lang_pred"] != "und" for r in edge if r["doc_id"] in (1, 6, 8))
    assert langid.language_id(no_docs).count() == 0
    assert {r["lang_pred"] for r in langid.language_id(edge_docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    kept = langid.keep_identified(edge_docs)
    assert kept.columns == edge_docs.columns and {r["doc_id"] for r in kept.collect()} == {1, None, 6, 7, 8, 50}


def test_out_of_place_distance_by_hand():
    def grams(text):
        words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
        n = Counter()
        line = " " + " ".join(words) + " "
        for size in (1, 2, 3):
            for i in range(len(line) - size + 1):
                g = line[i:i + size]
                if g.strip() and not (size == 3 and g[1] == " "):
                    n[g] += 1
        return n

    for text in ("The cat, the hat!", "\u00c9t\u00e9 \u00e0 la mer", "a", "1 2 3", "b.b.b"):
        assert sorted(grams(text).values()) == sorted(langid.ngram_counts(text)[1].tolist())
    a, b = (langid.ranked(*langid.ngram_counts(t)).tolist() for t in ("the cat sat on the mat", "le chat est sur le lit"))
    keys = langid.ranked(*langid.ngram_counts("the chat")).tolist()
    distance = [sum(abs(p.index(k) - n) if k in p else langid.PROFILE for n, k in enumerate(keys)) for p in (a, b)]
    lang, score = langid.Profiles({"en": a, "fr": b}).predict("the chat")
    assert lang == ("en", "fr")[distance.index(min(distance))]
    assert score == pytest.approx(1 - min(distance) / (langid.PROFILE * len(keys)))


def test_licenses(spark, edge_docs, no_docs):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    found = {r["doc_id"]: r for r in licenses.scan_licenses(docs).collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for key, text in texts.items():
        whole = {n for n, t in licenses.TEMPLATES.items() if t in (text or "")}
        assert whole <= set(found[key]["matches"].split(","))
        assert (found[key]["license"] is not None) == (found[key]["coverage"] >= licenses.COVERAGE)
    mit = licenses.TEMPLATES["MIT-text"]
    words = mit.split()
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.COVERAGE)
    assert scanner.scan(("x " * 50 + mit + " y z ") * 3)[:4] == ("MIT-text", 1.0, 50, 50 + len(licenses.words_of(mit)) - 1)
    changed = " ".join(w if n % 9 else "other" for n, w in enumerate(words))
    name, share, *_ = scanner.scan("intro " * 500 + changed)
    assert name == "MIT-text" and 0.8 <= share < 0.95
    assert scanner.scan(" ".join(words[: len(words) // 2]))[0] is None
    edge = licenses.scan_licenses(edge_docs).collect()
    assert len(edge) == edge_docs.count() and all(r["license"] is None and r["coverage"] == 0 for r in edge)
    assert licenses.scan_licenses(no_docs).count() == 0


def test_alignment_is_rising_and_equal():
    rng = random.Random(4)
    for _ in range(300):
        a, b = ([rng.choice("abcdefghij") for _ in range(rng.randrange(12))] for _ in range(2))
        pairs = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    assert len(licenses.align(list("abcxdef"), list("zzabcdefz"))) == 6


def test_licenses_cover_what_whole_alignment_covers():
    rng = random.Random(12)
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.COVERAGE)
    vocabulary = sorted(scanner.vocabulary)
    found = 0
    for _ in range(150):
        name, template = rng.choice(scanner.templates)
        fillers = ["other", "words", *rng.sample(vocabulary, 4)]
        text = [rng.choice(fillers) for _ in range(rng.randrange(400))]
        for w in template:
            text += [w] * (rng.random() > 0.05) + rng.choices(fillers, k=rng.randrange(rng.choice((1, 3, 8))))
        text += [rng.choice(fillers) for _ in range(rng.randrange(400))]
        pairs = licenses.align(template, text)
        share = len(pairs) / len(template)
        span = pairs[-1][1] - pairs[0][1] + 1
        matches = scanner.scan(" ".join(text))[4].split(",")
        if share >= licenses.COVERAGE and len(pairs) >= licenses.DENSITY * span:
            found += 1
            assert name in matches, (name, share)
    assert found > 30
    mit = licenses.words_of(licenses.TEMPLATES["MIT-text"])
    stretched = " ".join(w + " filler" for w in mit)
    assert scanner.scan(stretched)[:2] == ("MIT-text", 1.0)
    assert scanner.scan(" ".join([stretched] * 3))[:4] == ("MIT-text", 1.0, 0, 2 * len(mit) - 2)
    assert scanner.scan("all of the rights in this text are reserved")[:4] == ("All-rights-reserved", 1.0, 0, 8)
    apart = " ".join(w + " x" * 12 for w in mit)
    assert scanner.scan(apart)[0] is None


def test_many_texts_split_at_once(library, monkeypatch):
    own, rng = wordbpe.LibraryWords(PATH), random.Random(7)
    letters = [*"abXY01 '\n.,!stremvdl", "'s", "'ll", "'re ", "\u0178", "\u00e9", "\u00b2", "\x85", "\xa0", "\x7f", "\u017f"]
    plain = ["", "'", "''s", "'ll'll", "x'", "1'm2", "don't", *("".join(rng.choices(letters, k=rng.randrange(60))) for _ in range(3000))]
    odd = ["\u0130x", "\x1c a", "a \u6f22 b", "\U0001f600's", "a<|endoftext|>b", "e\u0301"]
    texts = [t for pair in zip(plain, odd * len(plain)) for t in pair]
    want = [as_bytes(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert own.encode_all(texts) == want
    monkeypatch.setattr(wordbpe, "SLICE_CHARS", 50)
    assert own.encode_all(texts) == want
    # Texts of the common range are not split one by one.
    monkeypatch.setattr(wordbpe, "SLICE_CHARS", 10_000)
    monkeypatch.setattr(own, "encode", None)
    assert own.encode_all(plain) == want[::2]
