"""Document quality by weak supervision.

Each rule of ``RULES`` looks at one property of a text and votes good,
votes bad, or abstains.  No rule decides alone: expectation-maximisation
(a two-class model with one pair of accuracies a rule, for good and for
bad documents, and the share of good documents) estimates from all
documents how far each rule's votes can be trusted, and a document is
kept if the posterior probability of good, given all its votes, is at
least ``KEEP``.

One narrow pass counts the properties (no shuffle; one row of numbers a
document, written once).  Votes are column expressions.  Only the counts
of vote patterns are gathered: there are at most 3 to the power of the
number of rules of them (2,187), whatever the input, and they follow all
documents.  The driver runs the estimation over these counts, and the
posterior of each pattern is joined back as a broadcast of that bound.

Words are runs of characters other than ASCII white space.

Defined results.  Null text: none, so all counts are 0, ``base_failed``
is true and ``kept`` false; the same for empty and wordless texts.  A
rule without enough to look at abstains; a document with abstentions only
gets the share of good documents.  Very long texts are read whole.
Repeated rows give repeated results, and each counts.  A null id stays
null.  Empty table: no rows.  Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import id_and_text, map_batches, written

KEEP = 0.5
MIN_WORDS = 50
ROUNDS, SETTLED = 200, 1e-9
# Where the estimation starts: rules seldom fault a good document, but each sees only half of the bad ones.
FIRST_ON_GOOD, FIRST_ON_BAD, FIRST_SHARE = 0.95, 0.5, 0.8
PSEUDO = 1.0  # documents added to each side of every estimated share

# Common function words of the languages at hand (fixed values).
STOP_WORDS = frozenset(w.encode() for w in (
    "the be to of and that have with a in is for "
    "que de la el los en y un una por "
    "le les et des est une dans pour "
    "der die das und ist von zu mit den ein").split())

# (rule, votes bad if, votes good if); neither: it abstains.
RULES = (
    ("symbols", "n_symbols > 0.1 * n_words", "n_symbols = 0 AND n_words >= 20"),
    ("repeated_words", "n_repeat_words > 0.3 * n_words", "n_repeat_words < 0.1 * n_words AND n_words >= 20"),
    ("repeated_lines", "n_dup_lines > 0.4 * n_lines", "n_dup_lines = 0 AND n_lines >= 4"),
    ("word_length", "word_chars < 3 * n_words OR word_chars > 10 * n_words",
     "word_chars BETWEEN 4 * n_words AND 7 * n_words AND n_words >= 20"),
    ("letters", "n_letter_words < 0.7 * n_words", "n_letter_words >= 0.9 * n_words AND n_words >= 20"),
    ("stop_words", "n_stop_words = 0 AND n_words >= 20", "n_stop_words >= 2"),
    ("line_ends", "n_ended_lines < 0.2 * n_lines AND n_lines >= 2", "n_ended_lines >= 0.8 * n_lines"),
)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letter_words",
          "n_stop_words", "n_ended_lines")
_SPACES = b" \t\n\v\f\r"
_SYMBOLS = b"#*$%&|<>"
_LETTER = re.compile(rb"[A-Za-z\x80-\xff]")
_ENDS = (b".", b"!", b"?", b'."', b'!"', b'?"', b":")


def repeated_words(numbers: np.ndarray) -> int:
    """Words that lie in a window of three words found twice or more."""
    if len(numbers) < 4:
        return 0
    kinds = int(numbers.max()) + 1
    window = numbers[:-1] * kinds + numbers[1:]
    if kinds ** 3 >= 1 << 62:
        window = np.unique(window, return_inverse=True)[1]
    window = window[:-1] * kinds + numbers[2:]
    _, kind, times = np.unique(window, return_inverse=True, return_counts=True)
    again = times[kind] > 1
    inside = np.zeros(len(numbers), bool)
    for shift in range(3):
        inside[shift:shift + len(again)] |= again
    return int(inside.sum())


def counts_of(text: bytes) -> tuple[int, ...]:
    """``COUNTS`` of a UTF-8 text."""
    words = text.split()  # at ASCII white space only
    numbers: dict[bytes, int] = {}
    placed = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    lines = [line for line in text.split(b"\n") if line.strip()]
    times = np.bincount(placed, minlength=len(numbers))
    lettered = np.fromiter((_LETTER.search(w) is not None for w in numbers), bool, len(numbers))
    inside = text.translate(None, _SPACES)
    return (len(words), len(inside.decode()), len(text) - len(text.translate(None, _SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(placed), len(lines), int(times[lettered].sum()),
            len(STOP_WORDS & {w.lower() for w in numbers}),
            sum(line.rstrip().endswith(_ENDS) for line in lines))


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and ``COUNTS`` of every row: narrow."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [counts_of(t) for t in batch.column("text").cast(pa.binary()).to_pylist()]
        columns = zip(*found) if found else [[] for _ in COUNTS]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns)],
                                          ["doc_id", *COUNTS])

    return map_batches(id_and_text(docs), count, ", ".join(["doc_id long", *(f"{c} long" for c in COUNTS)]))


def with_votes(measured: DataFrame, rules=RULES) -> DataFrame:
    """Adds ``votes``: for each rule 1 (good), -1 (bad) or 0."""
    votes = [F.when(F.col("n_words") == 0, 0).when(F.expr(bad), -1).when(F.expr(good), 1).otherwise(0)
             for _, bad, good in rules]
    return measured.withColumn("votes", F.array(*votes))


class Model:
    """Share of good documents, and for each rule how often its votes on
    good documents are good, and on bad ones bad."""

    def __init__(self, share: float, on_good: np.ndarray, on_bad: np.ndarray):
        self.share, self.on_good, self.on_bad = share, on_good, on_bad

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of good for each row of votes."""
        good, bad = votes > 0, votes < 0
        for_good = good @ np.log(self.on_good) + bad @ np.log1p(-self.on_good) + np.log(self.share)
        for_bad = good @ np.log1p(-self.on_bad) + bad @ np.log(self.on_bad) + np.log1p(-self.share)
        return 1 / (1 + np.exp(np.clip(for_bad - for_good, -700, 700)))


def estimate(votes: np.ndarray, n: np.ndarray) -> Model:
    """Expectation-maximisation over vote patterns that ``n`` documents
    have each.  Where it starts fixes which class is the good one, and that
    kinds of bad documents that different rules see are one class."""
    rules = votes.shape[1]
    model = Model(FIRST_SHARE, np.full(rules, FIRST_ON_GOOD), np.full(rules, FIRST_ON_BAD))
    good, bad = votes > 0, votes < 0
    for _ in range(ROUNDS):
        p = model.posterior(votes)
        share = (PSEUDO + n @ p) / (2 * PSEUDO + n.sum())
        yes, no = n * p, n * (1 - p)
        on_good = (PSEUDO + yes @ good) / (2 * PSEUDO + yes @ (good | bad))
        on_bad = (PSEUDO + no @ bad) / (2 * PSEUDO + no @ (good | bad))
        moved = max(abs(share - model.share), np.abs(on_good - model.on_good).max(), np.abs(on_bad - model.on_bad).max())
        model = Model(share, on_good, on_bad)
        if moved < SETTLED:
            break
    return model


def judge(docs: DataFrame, rules=RULES, keep: float = KEEP) -> DataFrame:
    """Counts, ``base_failed``, ``posterior`` and ``kept`` of every row."""
    voted = with_votes(written(measure(docs), "quality"), rules)
    patterns = voted.groupBy("votes").agg(F.count("*").alias("n")).collect()
    names = ["doc_id", *COUNTS, "base_failed", "posterior", "kept"]
    base = F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words")
    spark = docs.sparkSession
    known = spark.createDataFrame([], "votes array<int>, posterior double")
    if patterns:
        patterns.sort(key=lambda r: r["votes"])  # the same sums in the same order on every run
        votes = np.array([r["votes"] for r in patterns])
        model = estimate(votes, np.array([r["n"] for r in patterns], float))
        known = spark.createDataFrame(list(zip(votes.tolist(), model.posterior(votes).tolist())), known.schema)
    judged = voted.join(F.broadcast(known), "votes", "left").withColumn("base_failed", base)
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= keep)).select(*names)


def quality_report(docs: DataFrame) -> DataFrame:
    names = ["doc_id", *COUNTS[:5], "base_failed", "kept", "posterior"]
    return judge(docs).select(*names)


def keep_good(docs: DataFrame) -> DataFrame:
    """Ids of the documents that pass."""
    return judge(docs).where("kept").select("doc_id")
