"""Cases that once went wrong, and the pipeline stage by stage."""
import datetime
import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF001
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from test_llm_corpus_operators import simhash_classes

import corpus_pipeline
from ledgerline.llm import embeddings, langid, lines, pii, simhash, urlfilter

OWN_NAMES = ["found", "new", "own_id", "text_hash", "drop", "clean", "dropped", "group", "turn", "__found", "__new", "__clean",
             "__drop", "__root", "__turn", "root", "component_id", "FOUND_"]


def test_stages_leave_columns_of_any_name(spark):
    line = "The same line stands on many sites here."
    rows = [(n, f"{line}\nmail a{n}@example.com or 212-555-{1000 + n} now and then\nown words {n} {n * 7}", "en", f"s{n}", 9,
             *[f"{c}{n}" for c in OWN_NAMES]) for n in range(12)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in OWN_NAMES)
    docs = spark.createDataFrame(rows, schema)
    for stage in (lines.drop_boilerplate, simhash.keep_first, pii.pseudonymize, langid.keep_identified):
        out = stage(docs)
        assert out.columns == docs.columns
        kept = out.collect()
        assert kept and all(r[c] == f"{c}{r['doc_id']}" for r in kept for c in OWN_NAMES)


# ---- samples

def test_a_language_under_one_id_is_learned(spark):
    rng = random.Random(2)
    words = {"aa": ["lorem", "ipsum", "dolor", "amet"], "bb": ["quick", "brown", "jumps", "lazy"], "cc": ["xylo", "zyg", "wux", "vyx"]}
    text = lambda lang: " ".join(rng.choice(words[lang]) for _ in range(40))
    rows = [(1, text("aa"), "aa") for _ in range(6000)] + [(n, text("bb"), "bb") for n in range(400)]
    rows += [(1, "xylo zyg wux vyx zyg", "cc")] * 9000        # copies of a single text
    held = [r["doc_id"] for r in spark.range(60).select(F.col("id").alias("doc_id")).where(~langid.held_out()).collect()]
    rows = [(held[0] if k == 1 else k, t, lang) for k, t, lang in rows]
    profiles = langid.train_profiles(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample=200)
    assert sorted(profiles) == ["aa", "bb", "cc"]
    model = langid.Profiles(profiles)
    assert [model.predict(t)[0] for t in ("ipsum dolor amet", "lazy brown", "wux zyg")] == ["aa", "bb", "cc"]


def test_copies_of_a_url_do_not_fill_the_sample(spark, monkeypatch):
    seen = []
    fit = urlfilter.GBTClassifier.fit

    def counted(self, df):
        seen.append(df.agg(F.count("*"), F.sum("weight")).first())
        return fit(self, df)

    monkeypatch.setattr(urlfilter.GBTClassifier, "fit", counted)
    urls = ["http://b.net/fr/hot"] * 30_000 + [f"http://a{n}.com/x{n}" for n in range(3000)] + [f"http://b{n}.net/fr/{n}" for n in range(3000)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    assert urlfilter.judge(df, sample=500).count() == len(urls)
    assert 300 <= seen[0][0] <= 800


# ---- pseudonyms

def pseudonyms(spark, values):
    df = spark.createDataFrame(list(enumerate(values)), "n long, text string")
    return [r["text"] for r in pii.pseudonymize(df).orderBy("n").collect()]


def test_every_written_form_is_permuted_one_to_one(spark):
    day, values = datetime.date(1999, 1, 1), []
    for n in range(0, 1100):
        d = day + datetime.timedelta(n)
        values += [d.strftime("%d/%m/%Y"), d.strftime("%Y-%m-%d"), d.strftime("%d.%m.%Y")]
        values += [d.strftime("%m/%d/%Y")] if d.day > 12 else []
    edges = ["12/13/1900", "01/13/1900", "12/31/1999", "12/31/2099", "01/13/2000", "02/29/2000", "31/12/2099", "01/01/1900"]
    values = list(dict.fromkeys([*values, *edges]))
    out = pseudonyms(spark, values)
    assert len(set(out)) == len(values)
    for before, after in zip(values, out):
        assert re.sub(r"\d", "0", before) == re.sub(r"\d", "0", after)
        if "/" in before:
            a, b, year = map(int, after.split("/"))
            month_first = int(before.split("/")[1]) > 12
            assert (b > 12) == month_first and datetime.date(year, a if month_first else b, b if month_first else a)
        assert (re.search(r"\d{4}", before)[0] < "2000") == (re.search(r"\d{4}", after)[0] < "2000")


def test_late_days_of_a_century_are_all_reached(spark):
    for first, last in ((datetime.date(1900, 1, 1), 36_524), (datetime.date(2000, 1, 1), 36_525)):
        days = [first + datetime.timedelta(n) for n in range(last)]
        values = [d.strftime("%m/%d/%Y") for d in days if d.day > 12]
        assert sorted(pseudonyms(spark, values)) == sorted(values)


def test_secrets_of_any_letters_are_permuted_one_to_one(spark):
    rng = random.Random(3)
    values = ["token=" + "".join(rng.choice("abcdef" if n % 2 else "abcdefghijklmnopqrstuvwxyz") for _ in range(2)) + "0000000000"
              for n in range(4000)]
    values = sorted(set(values))
    assert len(set(pseudonyms(spark, values))) == len(values) > 600


# ---- embeddings

def recall(spark, unit):
    want = np.concatenate([(unit[s:s + 1000] @ unit.T >= 0.9).sum(axis=1) - 1 for s in range(0, len(unit), 1000)])
    df = spark.createDataFrame([(n, v.tolist()) for n, v in enumerate(unit)], "vec_id long, embedding array<double>")
    found = np.zeros(len(unit), int)
    for r in embeddings.near_duplicates(df).collect():
        found[r["vec_id"]] = r["n_links"]
    assert (found <= want).all() and want.sum() > 0
    return found.sum() / want.sum()


def unit_rows(rows):
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def test_recall_on_the_check_tables(spark):
    rows = spark.read.parquet("/root/testdata/check_h/embeddings.parquet").where("embedding IS NOT NULL").limit(4000).collect()
    unit = np.array([r["embedding"] for r in rows], float)
    assert recall(spark, unit_rows(unit[np.linalg.norm(unit, axis=1) > 0])) >= 0.9


def crowd_and_pairs(rng):
    """A crowd around one vector, a ring at the linking angle, and pairs."""
    centre = unit_rows(rng.normal(size=(1, 24)))
    near = unit_rows(centre + 0.02 * rng.normal(size=(400, 24)))
    ring = unit_rows(centre + 0.48 * unit_rows(rng.normal(size=(60, 24))))
    base = unit_rows(rng.normal(size=(300, 24)))
    return np.concatenate([near, ring, base, unit_rows(base + 0.03 * rng.normal(size=base.shape))])


def test_crowds_are_exact(spark, monkeypatch):
    unit = crowd_and_pairs(np.random.default_rng(4))
    df = spark.createDataFrame([(n, v.tolist()) for n, v in enumerate(unit)], "vec_id long, embedding array<double>")
    classes = embeddings.distinct_vectors(df)
    pivots = embeddings.choose_pivots(classes)
    members, centres = embeddings.crowded(embeddings.describe(classes, pivots), 0.9)
    entries = embeddings.entries_of(members, centres, pivots)
    crowds = entries.where("n > 1").collect()
    assert crowds and sum(r["n"] for r in crowds) > 200 and entries.agg(F.sum("n")).first()[0] == len(unit)
    inside = {}
    for r in members.join(classes.drop("many", "first_id"), "cid").collect():
        inside.setdefault(r["e"], []).append(r["vec"])
    for r in crowds:  # what is counted without being compared does link
        rows = np.array(inside[r["e"]])
        assert len(rows) == r["n"] and (rows @ rows.T >= 0.9).all()
        assert (np.arccos(np.clip(rows @ np.frombuffer(r["unit"]), -1, 1)) <= r["radius"]).all()
    want = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    plain = {r["vec_id"]: tuple(r)[1:] for r in embeddings.near_duplicates(df).collect()}
    found = np.array([plain[n][0] for n in range(len(unit))])
    assert (found <= want).all() and found.sum() >= 0.99 * want.sum()
    # Lists of pairs of pivots, and opened crowds in blocks, retrieve the same.
    monkeypatch.setattr(embeddings, "LONG", 1)
    assert {r["vec_id"]: tuple(r)[1:] for r in embeddings.near_duplicates(df).collect()} == plain
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    assert {r["vec_id"]: tuple(r)[1:] for r in embeddings.near_duplicates(df).collect()} == plain


def test_recall_in_three_dimensions_and_near_the_threshold(spark):
    rng = np.random.default_rng(6)
    assert recall(spark, unit_rows(rng.normal(size=(1500, 3)))) >= 0.99
    base, other = unit_rows(rng.normal(size=(4000, 64))), rng.normal(size=(4000, 64))
    other = unit_rows(other - (other * base).sum(axis=1, keepdims=True) * base)
    close = rng.uniform(0.9, 0.97, (4000, 1))
    assert recall(spark, np.concatenate([base, close * base + np.sqrt(1 - close ** 2) * other])) >= 0.95


# ---- the pipeline, stage by stage

def plain_boilerplate(rows, least=8):
    sites, first = defaultdict(set), {}
    for key, text, source in rows:
        for line in (text or "").split("\n"):
            if (k := line.strip(" ")):
                sites[k] |= {source} - {None}
                first[k] = min(key, first.get(k, key))
    gone = lambda key, line: len(sites.get(k := line.strip(" "), ())) >= least and first[k] != key
    return [(key, None if text is None else "\n".join(x for x in text.split("\n") if not gone(key, x)), source) for key, text, source in rows]


@pytest.fixture(scope="module")
def corpus(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    common = "This very line is printed at the foot of pages all over the place."
    rows = docs.collect()
    body = next(r["text"] for r in rows if r["text"] and len(r["text"]) > 1500)
    more = [(100_000 + n, f"{body[:400]}\n{common}\nCall 212-555-{1000 + n} or mail x{n}@example.org today.", "en", f"site{n}", 0) for n in range(10)]
    more += [(200_000, body, "en", "copy", 0), (200_001, body + " end", "en", "copy", 0), (200_002, "12345 !!!", "en", "n", 0),
             (200_003, None, None, None, None), (200_004, "", "en", "e", 0)]
    return docs.unionByName(spark.createDataFrame(more, docs.schema)).cache()


def test_stages_equal_plain_versions(spark, corpus, tmp_path):
    library = Tokenizer.from_file("/opt/tokenizers/word_bpe_49k.json")
    library.no_truncation(), library.no_padding()
    at = corpus
    results = []
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, at, SF001).write.parquet(str(tmp_path / str(n)))
        at = spark.read.parquet(str(tmp_path / str(n)))
        results.append(at)
    texts = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)

    # Language ID drops what has no letter, and nothing else here.
    lettered = [r for r in corpus.collect() if r["text"] and any(map(str.isalpha, r["text"]))]
    assert texts(results[0]) == sorted([(r["doc_id"], r["text"]) for r in lettered], key=repr)
    # Line dedup.
    cleaned = plain_boilerplate([(r["doc_id"], r["text"], r["source"]) for r in lettered])
    assert texts(results[1]) == sorted([(k, t) for k, t, _ in cleaned], key=repr)
    assert sum("printed at the foot" in t for _, t, _ in cleaned) == 1
    # One document of each SimHash group.
    prints = {k: simhash.fingerprint(t) for k, t, _ in cleaned}
    named = {key for key, _, first in simhash_classes([(k, prints[k]) for k, _, _ in cleaned]) if key == first}
    kept = [(k, t) for k, t, _ in cleaned if k in named]
    assert texts(results[2]) == sorted(kept, key=repr) and len(kept) < len(cleaned)
    # PII: the same documents; values gone, shapes kept, other texts untouched.
    after = dict(texts(results[3]))
    assert after.keys() == dict(kept).keys()
    shape = lambda t: re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]+", "0", t)))
    for key, text in kept:
        assert shape(after[key]) == shape(text)
        assert not re.search(r"x\d@example.org|212-555-10\d\d", after[key])
        if not re.search(r"\d\d|@|AKIA|(?i:passw|secret|token|api_key)|\d\.\d", text):
            assert after[key] == text
    # Packing: each document's ids once, in sequences of at most 2,048.
    n_ids = {k: len(library.encode(t, add_special_tokens=False).ids) + 1 for k, t in after.items()}
    pieces, filled = Counter(), defaultdict(list)
    for r in results[4].collect():
        assert r["doc_tokens"] == n_ids[r["doc_id"]]
        pieces[r["doc_id"]] += r["length"]
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    assert pieces == n_ids
    for spans in filled.values():
        spans.sort()
        assert [o for o, _ in spans] == [sum(n for _, n in spans[:i]) for i in range(len(spans))] and sum(n for _, n in spans) <= 2048


def test_pipeline_on_an_empty_table(spark, tmp_path):
    spark.read.parquet(f"{SF001}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def sha(key, kind, i, *others):
    return hashlib.sha256("|".join([key, kind, str(i), *map(str, others)]).encode()).hexdigest()


def plain_string(kind, key, value):
    """The string network, written apart from the operator's SQL."""
    halves = [value[:len(value) // 2], value[len(value) // 2:]]
    for i in range(pii.ROUNDS):
        mine, stream = halves[i % 2], bytes.fromhex(sha(key, kind, i, halves[1 - i % 2]))
        new = ""
        for at, c in enumerate(mine):
            base = next((b for b, n in (("0", 10), ("a", 26), ("A", 26)) if b <= c < chr(ord(b) + n)), None)
            size = 10 if base == "0" else 26
            new += c if base is None else chr(ord(base) + (ord(c) - ord(base) + stream[at % 32]) % size)
        halves[i % 2] = new
    return "".join(halves)


def plain_number(kind, key, values, sizes):
    """The number network of up to three coordinates."""
    p, m = [*values, 0, 0][:3], [*sizes, 1, 1][:3]
    for i in range(pii.ROUNDS):
        n = i % 3
        others = [p[k] for k in range(3) if k != n]
        p[n] = (p[n] + int(sha(key, kind, i, *others)[:14], 16)) % m[n]
    return p


def test_pseudonyms_equal_a_plain_feistel(spark):
    rng, key = random.Random(8), "a key"
    first = {1900: (datetime.date(1900, 1, 1), 92, 397), 2000: (datetime.date(2000, 1, 1), 75, 487)}
    texts, want = [], []
    for _ in range(60):
        name = "".join(rng.choice("abcXYZ019._-") for _ in range(rng.randrange(1, 14)))
        texts.append(f"{name}@mail.example.org")
        want.append(plain_string("email", key, name) + "@mail.example.org")
        octets = [rng.randrange(256) for _ in range(4)]
        texts.append(".".join(map(str, octets)))
        x, y, _ = plain_number("ip", key, [octets[0] * 256 + octets[1], octets[2] * 256 + octets[3]], [65536, 65536])
        want.append(f"{x // 256}.{x % 256}.{y // 256}.{y % 256}")
        area, group, serial = rng.choice([n for n in range(1, 900) if n != 666]), rng.randrange(1, 100), rng.randrange(1, 10000)
        texts.append(f"{area:03d}-{group:02d}-{serial:04d}")
        areas = [n for n in range(1, 900) if n != 666]
        x, y, z = plain_number("ssn", key, [areas.index(area), group - 1, serial - 1], [898, 99, 9999])
        want.append(f"{areas[x]:03d}-{y + 1:02d}-{z + 1:04d}")
        day = datetime.date(1900, 1, 1) + datetime.timedelta(rng.randrange(36524 + 36525))
        start, rows, width = first[1900 if day.year < 2000 else 2000]
        texts.append(day.isoformat())
        x, y, _ = plain_number("date", key, [(day - start).days // width, (day - start).days % width], [rows, width])
        want.append((start + datetime.timedelta(x * width + y)).isoformat())
    df = spark.createDataFrame([(n, f"see {t} there") for n, t in enumerate(texts)], "n int, text string")
    got = [r["text"] for r in pii.pseudonymize(df, key).orderBy("n").collect()]
    assert got == [f"see {w} there" for w in want]
