"""Conversation repair, ranked lexical search, quality rules."""
import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from conftest import SF001, SF01
from llm_cases import edge_docs, no_docs  # noqa: F401

from ledgerline.llm import conversations, lexical, quality
from ledgerline.llm.common import table

WORD = re.compile("[^\x20\x09-\x0d]+")
NAMES = "conv_id long, turn long, role string, text string, conv string, place string, copy string, hit string, codes string"


# ---- conversation repair -------------------------------------------------

def sequences(rows):
    """(cost, audit, role initials) of every edit of the rows, with up to
    two insertions at each place; rows are (initial, fault)."""
    inserts = [p for n in range(3) for p in itertools.product("ua", repeat=n)]
    choices = []
    for initial, fault in rows:
        edits = [(2, "D", "")]
        if fault not in ("blank", "duplicate"):
            extra = 5 if fault == "truncated" else 0
            edits += [(extra, "K", initial), (1 + extra, "R", "u"), (1 + extra, "R", "a")]
        choices.append([(5 * len(p) + c, "I" * len(p) + e, "".join(p) + r) for p in inserts for c, e, r in edits])
    choices.append([(5 * len(p), "I" * len(p), "".join(p)) for p in inserts])
    return itertools.product(*choices)


def best_by_enumeration(rows):
    best = None
    for parts in sequences(rows):
        key = (sum(p[0] for p in parts), "".join(p[1] for p in parts))
        if (best is None or key < best) and re.fullmatch("(s?(ua)+)?", "".join(p[2] for p in parts)):
            best = key
    return best


def test_repair_equals_enumeration():
    kinds = [(i, f) for i in "sua-" for f in conversations.FAULTS]
    rng = random.Random(3)
    cases = [[]] + [[k] for k in kinds] + [[a, b] for a in kinds for b in kinds]
    cases += [[rng.choice([("u", ""), ("a", ""), ("s", ""), *kinds]) for _ in range(3)] for _ in range(25)]
    for rows in cases:
        cost, audits = conversations.repair("".join(conversations._code(*r) for r in rows))
        assert (cost, "".join(audits)) == best_by_enumeration(rows), rows


def plain_best(rows):
    """(cost, audit) by a DP over strings, from the first row to the last."""
    after = {("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a", ("", "s"): "s"}
    states = {"": (0, "")}

    def insert(states):
        for _ in range(2):
            more = dict(states)
            for s, (c, a) in states.items():
                for r in "ua":
                    if (s, r) in after:
                        t = after[s, r]
                        more[t] = min(more.get(t, (math.inf, "")), (c + 5, a + "I"))
            states = more
        return states

    for initial, fault in rows:
        new = {}
        for s, (c, a) in insert(states).items():
            steps = [(s, c + 2, "D")]
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault == "truncated" else 0
                steps += [(after[s, initial], c + extra, "K")] if (s, initial) in after else []
                steps += [(after[s, r], c + 1 + extra, "R") for r in "ua" if (s, r) in after]
            for t, cost, letter in steps:
                new[t] = min(new.get(t, (math.inf, "")), (cost, a + letter))
        states = new
    states = insert(states)
    return min(states[s] for s in ("", "a") if s in states)


def test_blocks_do_not_change_the_repair(monkeypatch):
    rng = random.Random(4)
    kinds = [("s", ""), ("u", ""), ("a", ""), ("-", ""), ("u", "truncated"), ("a", "truncated"), ("a", "blank"), ("u", "duplicate")]
    cases = [[rng.choice(kinds) for _ in range(rng.randrange(1, 60))] for _ in range(150)]
    cases += [[("u", "")] * 300, [("a", "")] * 300, [("u", ""), ("a", "")] * 300, [rng.choice(kinds) for _ in range(700)]]
    want = [plain_best(rows) for rows in cases]
    for block in (256, 1, 2, 7):
        monkeypatch.setattr(conversations, "BLOCK", block)
        for rows, (cost, audit) in zip(cases, want):
            found = conversations._repair("".join(conversations._code(*r) for r in rows))
            assert (found[0], "".join(found[1])) == (cost, audit), (block, rows)
            assert len(found[1]) == -(-len(rows) // block)


def plain_report(table_rows):
    """The whole contract, row by row."""
    text = lambda v: " " if v is None else str(v)
    every, groups = {}, defaultdict(list)
    for conv, turn, role, body in table_rows:
        every[text(conv)] = conv
        hit = zlib.crc32(f"{text(conv)}:{text(turn)}".encode()) % 20
        role, body = text(role), text(body)
        body = "" if hit == 1 else re.sub("[.!?]", "", body) if hit == 2 else body
        groups[text(conv)] += [((turn is not None, turn or 0, "user" if hit == 4 else role, body), turn)] * (0 if hit == 0 else 2 if hit == 3 else 1)
    out = []
    for conv, original in every.items():
        rows = sorted(groups[conv], key=lambda r: r[0])
        turns = [t for _, t in rows if t is not None]
        seen, faults = set(), []
        for (_, _, role, body), _ in rows:
            words = WORD.findall(body)
            faults.append("blank" if not words else "duplicate" if (role, body) in seen
                          else "truncated" if words[-1][-1] not in ".!?" else "")
            seen.add((role, body))
        roles = [r[0][2] for r in rows]
        initials = [r[:1] or "-" for r in roles]
        cost, audit = plain_best(list(zip(initials, faults)))
        lines, state, at = [], "", 0
        for edit in audit:
            new = "a" if state == "u" else "u"
            if edit == "I":
                lines.append({"u": "user:", "a": "assistant:"}[new])
                state = new
                continue
            role, body = rows[at][0][2:]
            at += 1
            if edit == "K":
                lines.append(f"{role}:{body}")
                state = role[0]
            elif edit == "R":
                lines.append({"u": "user:", "a": "assistant:"}[new] + body)
                state = new
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        out.append((original, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                    *(faults.count(f) for f in conversations.FAULTS[1:]), illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def report(df):
    return sorted(map(tuple, conversations.repair_report(df).collect()), key=repr)


def test_repair_report_on_the_table(spark):
    df = table(spark, SF01, "conversations")
    rows = df.select("conv_id", "turn", "role", "text").collect()
    assert report(df) == plain_report(map(tuple, rows))


def test_repair_report_on_edges(spark):
    extra = ("x",) * 5
    rng = random.Random(9)
    rows = [(1, None, "user", "a.", *extra), (1, 0, None, "b", *extra), (1, 0, "user", None, *extra), (1, 2, "", "c?", *extra),
            (None, 3, "user", "d.", *extra), (None, None, None, None, *extra), (2, None, "tool", "x.", *extra),
            (3, 9, "user", "e" * 500_000 + " \n", *extra), (4, 1, "User", "f  ", *extra), (4, 1, "agent", "g!\x1c", *extra),
            (5, 10 ** 15, "system", "h.", *extra), (5, -5, "user", "i.", *extra), (5, 10 ** 15, "system", "h.", *extra),
            (7, None, "system", ".", *extra)]
    rows += [(6, t, rng.choice(["user", "assistant", "system"]), rng.choice(["hm", "yes.", "no!", f"w{t}.", " "]), *extra)
             for t in range(700)]
    rows += [(8, 1, rng.choice(["user", "assistant"]), "tie.", *extra) for _ in range(300)]
    df = spark.createDataFrame(rows, NAMES)
    assert report(df) == plain_report(r[:4] for r in rows)
    assert conversations.repair_report(spark.createDataFrame([], NAMES)).count() == 0


# ---- ranked lexical search -----------------------------------------------

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_search(docs, items, k=10):
    counted = [(i, Counter(plain_terms(t))) for i, t in docs]
    counted = [(i, c, c.total()) for i, c in counted if c]
    total, words = len(counted), sum(n for _, _, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    asked = defaultdict(set)
    for item, text in items:
        asked[item] |= set(plain_terms(text))
    out = []
    for item, terms in asked.items():
        scored = []
        for doc, c, n in counted:
            m = 100 - 90 + (90 * n * total) // words
            s = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in terms if c[t])
            if s > 0:
                scored.append((-s, doc is None, doc or 0, doc))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def ranked(docs, items, **more):
    return sorted(map(tuple, lexical.ranked_search(docs, items, **more).collect()), key=repr)


@pytest.mark.parametrize("block", [lexical.BLOCK, 300])
def test_ranked_search_is_exact(spark, block, monkeypatch):
    monkeypatch.setattr(lexical, "SEGMENT_CHARS", 300_000)
    docs, items = table(spark, SF01, "documents"), table(spark, SF01, "benchmark")
    want = plain_search(docs.select("doc_id", "text").collect(), items.select("item_id", "text").collect())
    assert want and ranked(docs, items, block=block) == want


def test_ranked_search_on_edges(spark, edge_docs, no_docs):  # noqa: F811
    asked = [(1, "quick FOX fox", "x"), (1, "dog!", "x"), (None, "lorem ipsum", "x"), (2, None, "x"), (3, "", "x"), (4, "a", "x"),
             (5, "ΣΑΣ 你好 zzz", "x"), (6, "12345 909", "x")]
    items = spark.createDataFrame(asked, "item_id long, text string, term string")
    want = plain_search(edge_docs.select("doc_id", "text").collect(), [a[:2] for a in asked])
    assert want and ranked(edge_docs, items) == want
    assert ranked(no_docs, items) == [] and ranked(edge_docs, items.limit(0)) == []


def test_accumulators_and_skips():
    """Exact with any mix of short and long lists, and most postings of
    long lists are never scored."""
    rng = np.random.default_rng(7)
    number = {f"t{n}".encode(): n for n in range(40)}
    filing = lexical._Filing()
    share = np.r_[np.full(20, 0.01), np.linspace(0.1, 0.9, 20)]
    texts = [b" ".join(f"t{t}".encode() for t in np.flatnonzero(rng.random(40) < share) for _ in range(rng.integers(1, 4)))
             for _ in range(20_000)]
    for n, text in enumerate(texts):
        filing.add(n, text, number)
    row = {name: column[0].as_py() for name, column in zip(filing.batch().schema.names, filing.batch().columns)}
    df = np.zeros(40, np.int64)
    df[np.frombuffer(row["terms"], np.int32)] = np.frombuffer(row["sizes"], np.int32)
    segment = lexical.Segment(row, lexical.weights(df, row["n_docs"]), row["n_docs"], row["n_terms"])
    whole = np.zeros((40, segment.n), np.int64)
    for at, term in enumerate(segment.terms):
        whole[term, segment.docs[segment.postings(at)]] = segment.value[segment.postings(at)]
    scored = 0
    for _ in range(60):
        query = np.sort(rng.choice(40, rng.integers(1, 25), replace=False)).astype(np.int32)
        best = lexical.Best(10)
        scored += lexical.search(segment, query, best)
        score = whole[query].sum(axis=0)
        top = np.lexsort((segment.ids, -score))[:10]
        top = top[score[top] > 0]
        assert best.score.tolist() == score[top].tolist() and best.ids.tolist() == segment.ids[top].tolist()
    assert scored < 0.25 * 60 * segment.n


def test_impacts_beyond_64_bits():
    tf, length = np.array([3, 1]), np.array([10 ** 9, 5])
    total, words = 10 ** 12, 3 * 10 ** 14
    want = [10 ** 9 * t // (1000 * t + 8 * (100 - 90 + (90 * n * total) // words)) for t, n in zip(tf.tolist(), length.tolist())]
    assert lexical.impacts(tf, length, total, words).tolist() == want


# ---- quality rules -------------------------------------------------------

def plain_counts(text):
    words = WORD.findall(text or "")
    windows = list(zip(words, words[1:], words[2:]))
    times = Counter(windows)
    inside = {i + s for i, w in enumerate(windows) if times[w] > 1 for s in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    again = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text or "")), again, len(inside)


def test_counts_by_definition(spark, edge_docs, no_docs):  # noqa: F811
    docs = table(spark, SF001, "documents").select("doc_id", "text")
    odd = spark.createDataFrame([(-1, "a b c a b c a\x0bb\x0cc"), (-2, "  x y \x1c z\n\n x\nx\nx \n"), (-3, "a a a a a"),
                                 (-4, "a b"), (None, "<|> #\n#")], docs.schema)
    rows = docs.unionByName(odd).unionByName(edge_docs.select("doc_id", "text"))
    found = Counter(tuple(r[:6]) for r in quality.measure(rows).collect())
    assert found == Counter((r["doc_id"], *plain_counts(r["text"])) for r in rows.collect())
    for r in quality.quality_report(rows).collect():
        base = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == base and (not r["kept"] or not base) and r["kept"] is not None
    assert quality.quality_report(edge_docs).count() == edge_docs.count()
    assert quality.quality_report(no_docs).count() == 0


def test_repeated_words_of_many_kinds():
    rng = random.Random(1)
    words = [rng.randrange(2_000_000) for _ in range(3000)]
    words += words[100:150] + [3_000_000]
    numbers = np.array(words)
    windows = Counter(zip(words, words[1:], words[2:]))
    want = {i + s for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for s in range(3)}
    assert quality.repeated_words(numbers) == len(want) == 100


def test_estimate_recovers_accuracies():
    rng = np.random.default_rng(5)
    n, share = 60_000, 0.8
    on_good, on_bad, heard = np.array([.98, .95, .9, .97, .93]), np.array([.6, .7, .5, .4, .8]), 0.8
    good = rng.random(n) < share
    right = rng.random((n, 5)) < np.where(good[:, None], on_good, on_bad)
    votes = np.where(rng.random((n, 5)) < heard, np.where(right == good[:, None], 1, -1), 0)
    patterns, times = np.unique(votes, axis=0, return_counts=True)
    model = quality.estimate(patterns, times.astype(float))
    assert abs(model.share - share) < 0.03
    assert np.abs(model.on_good - on_good).max() < 0.02 and np.abs(model.on_bad - on_bad).max() < 0.06
    # A posterior is calibrated: of the documents near 0.9, about 0.9 are good.
    p = model.posterior(votes)
    for low in (0.05, 0.3, 0.8):
        near = (p > low) & (p < low + 0.15)
        assert near.sum() < 300 or abs(good[near].mean() - p[near].mean()) < 0.06


def test_quality_against_labels(spark):
    """No label is read by the method."""
    found = quality.judge(table(spark, SF01, "documents")).join(table(spark, SF01, "labels"), "doc_id").where("NOT base_failed").collect()
    good, bad = [r for r in found if r["quality"] == 1], [r for r in found if r["quality"] == 0]
    assert sum(r["kept"] for r in good) >= 0.99 * len(good) > 0
    assert sum(not r["kept"] for r in bad) >= 0.9 * len(bad) > 0


def test_oracle_of_ranked_search():
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF001}/{name}.parquet'")
    want = plain_search(con.execute("SELECT doc_id, text FROM documents").fetchall(),
                        con.execute("SELECT item_id, text FROM benchmark").fetchall())
    assert sorted(con.execute(lexical.ORACLE).fetchall(), key=repr) == want
