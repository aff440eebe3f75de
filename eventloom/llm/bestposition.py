"""Ranked lexical search by the best position algorithm.

For each item the ``k`` documents of the highest scores, exactly. A document's impact for a term is
known once the terms of all documents are counted; its score is the sum of the impacts of the
item's terms. Documents are cut into blocks; a block keeps, for the terms of the items only,
a list of documents for each term in the order of impact and, for direct access, the same
list in the order of documents.

For an item a block's lists are read from the top, all alike far. Each document met is looked
up directly in all lists, which marks its place there as seen; a list's best position is the end of
its unbroken run of seen places. A document not met stands behind the best position of
each list that has it, so the sum of the impacts behind the best positions bounds its score. Reading
stops when this bound is strictly below the k-th score found: equal scores are still found, and
come in the order of ids. The k-th score is that of all blocks a task has read so far.

Items come to the driver in groups of at most ``GROUP_BYTES`` of text (one item at least), and each
group goes to all blocks, so what is sent is bounded; the documents are read once for the counts
and blocks of each group. Of each task at most k documents an item go on, and of these the
rank filter of Spark keeps k before it shuffles.

Defined results: a null or empty text has no terms and is never found; texts of any length are
read whole; each of repeated rows is ranked; ties go by id, a null id last; repeated
items each have their result, a null item id too; no documents or no items give an empty
result; columns other than those named are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import bytes_of, quoted, ship, written

BEST = 50
GROUP_BYTES = 4_000_000
BLOCK_DOCUMENTS = 16_384
BLOCK_POSTINGS = 2_000_000
FIRST_READ = 64  # places read from each list at first; twice as many each time

#: Letters of ASCII are lower-cased; what is no letter or digit there separates terms.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms(text) -> list[bytes]:
    """Terms of a text: runs of ASCII letters and digits and of all other characters, A to Z in lower case."""
    return bytes_of(text).translate(_TERMS).split()


@dataclass(frozen=True)
class Corpus:
    """Documents with a term, terms of all documents, and weights of a group's terms."""

    documents: int
    length: int
    weights: np.ndarray


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def impacts(weights: np.ndarray, tf: np.ndarray, n: np.ndarray, corpus: Corpus) -> np.ndarray:
    """A document's part of the score for a term, in whole numbers."""
    m = 50 + (50 * n * corpus.documents) // max(1, corpus.length)
    return weights * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


# --- blocks ---------------------------------------------------------------------------

_BLOCK = "ids array<bigint>, lengths binary, docs binary, terms binary, tfs binary, holding binary, documents bigint, length bigint"


def _blocks(docs: DataFrame, text: str, doc_id: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """Documents in blocks: ids and lengths of those with a wanted term, their postings, and counts over all."""
    rows = docs.select(F.col(quoted(doc_id)).cast("bigint").alias("doc_id"), F.col(quoted(text)).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        ids, lengths, at, which, tfs, documents, length = [], [], [], [], [], 0, 0

        def flush() -> pa.RecordBatch:
            wanted = np.array(which, np.int32)
            holding = np.bincount(wanted, minlength=len(known)).astype(np.int64)
            packed = (np.array(lengths, np.int64), np.array(at, np.int32), wanted, np.array(tfs, np.int64), holding)
            columns = [pa.array([x.tobytes()], pa.binary()) for x in packed]
            counts = [pa.array([x], pa.int64()) for x in (documents, length)]
            names = ["ids", "lengths", "docs", "terms", "tfs", "holding", "documents", "length"]
            return pa.record_batch([pa.array([ids], pa.list_(pa.int64())), *columns, *counts], names=names)

        for batch in batches:
            for doc, body in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                found = terms(body.as_py())
                if not found:
                    continue
                documents, length = documents + 1, length + len(found)
                mine = [(known[t], n) for t, n in Counter(found).items() if t in known]
                if mine:
                    at += [len(ids)] * len(mine)
                    ids.append(doc)
                    lengths.append(len(found))
                    which += [t for t, _ in mine]
                    tfs += [n for _, n in mine]
                if len(ids) >= BLOCK_DOCUMENTS or len(which) >= BLOCK_POSTINGS:
                    yield flush()
                    ids, lengths, at, which, tfs, documents, length = [], [], [], [], [], 0, 0
        if documents:
            yield flush()

    return rows.mapInArrow(cut, _BLOCK)


class Lists:
    """A block's lists: places by impact, documents by number, and where each list begins."""

    def __init__(self, row, corpus: Corpus):
        self.size = len(row.ids)
        docs, which = np.frombuffer(row.docs, np.int32), np.frombuffer(row.terms, np.int32)
        lengths, tfs = np.frombuffer(row.lengths, np.int64), np.frombuffer(row.tfs, np.int64)
        value = impacts(corpus.weights[which], tfs, lengths[docs], corpus)
        # Documents are numbered in the order they were read, so a stable sort by term keeps theirs.
        by_term = np.argsort(which, kind="stable")
        self.docs, self.value = docs[by_term], value[by_term]
        self.starts = np.searchsorted(which[by_term], np.arange(len(corpus.weights) + 1))
        self.by_impact = np.lexsort((self.docs, -self.value, which[by_term]))
        self.place = np.empty(len(docs), np.int64)
        self.place[self.by_impact] = np.arange(len(docs))

    def best(self, wanted: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and scores of documents that hold all k best of this block not below ``floor``."""
        lists = [(a, b) for a, b in zip(self.starts[wanted], self.starts[wanted + 1]) if b > a and self.value[self.by_impact[a]] > 0]
        score, met = np.zeros(self.size, np.int64), np.zeros(self.size, bool)
        seen = [np.zeros(b - a + 1, bool) for a, b in lists]  # the last place is never seen: it stands for the end
        behind = np.zeros(len(lists), np.int64)
        read, step, kth = 0, FIRST_READ, floor
        while True:
            places = [self.by_impact[a + read : min(a + read + step, b)] for a, b in lists]
            new = np.unique(np.concatenate([self.docs[p] for p in places])) if lists else np.zeros(0, np.int32)
            new = new[~met[new]]
            met[new] = True
            bound = 0
            for i, (a, b) in enumerate(lists):
                at = a + np.searchsorted(self.docs[a:b], new)
                at[at == b] = a
                hit = self.docs[at] == new
                score[new[hit]] += self.value[at[hit]]
                seen[i][self.place[at[hit]] - a] = True
                behind[i] += np.argmin(seen[i][behind[i] :])
                if behind[i] < b - a:
                    bound += int(self.value[self.by_impact[a + behind[i]]])
            if met.sum() >= k:
                kth = max(kth, int(np.partition(score[met], -k)[-k]))
            if bound < kth or bound == 0:
                break
            read, step = read + step, 2 * step
        found = np.flatnonzero(met & (score > 0) & (score >= kth))
        return found, score[found]


def _trimmed(found: pd.DataFrame, k: int) -> pd.DataFrame:
    return found.sort_values(["score", "doc_id"], ascending=[False, True], na_position="last", kind="stable").head(k)


_FOUND = "item int, doc_id bigint, score bigint"


def _searched(blocks: DataFrame, items: list[np.ndarray], corpus: Corpus, k: int) -> DataFrame:
    """The k best documents of each task for each item of a group."""
    shared = blocks.sparkSession.sparkContext.broadcast((items, corpus))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items, corpus = shared.value
        best: dict[int, pd.DataFrame] = {}
        for batch in batches:
            for row in batch.itertuples():
                lists = Lists(row, corpus)
                ids = pd.array(row.ids, "Int64")
                for i, wanted in enumerate(items):
                    before = best.get(i)
                    floor = int(before.score.iloc[-1]) if before is not None and len(before) == k else 1
                    at, score = lists.best(wanted, k, floor)
                    if len(at):
                        mine = pd.DataFrame({"doc_id": ids[at], "score": score})
                        best[i] = _trimmed(mine if before is None else pd.concat([before, mine]), k)
        if best:
            yield pd.concat([x.assign(item=np.int32(i))[["item", "doc_id", "score"]] for i, x in best.items()])

    return blocks.select("ids", "lengths", "docs", "terms", "tfs").mapInPandas(search, _FOUND)


def _groups(items: DataFrame, item_id: str, text: str) -> Iterator[list[tuple]]:
    """Items in groups of bounded size."""
    group, size = [], 0
    for row in items.select(F.col(quoted(item_id)), F.col(quoted(text))).toLocalIterator():
        body = bytes_of(row[1])
        if group and size + len(body) > GROUP_BYTES:
            yield group
            group, size = [], 0
        group.append((row[0], body.decode("utf-8", "surrogatepass")))
        size += len(body)
    if group:
        yield group


def ranked(
    docs: DataFrame,
    items: DataFrame,
    k: int = BEST,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """For each item its best documents: ``item_id``, ``rank``, ``doc_id``, ``score``."""
    spark = docs.sparkSession
    ship(spark)
    kind = items.schema[item_id].dataType
    results = []
    for group in _groups(items, item_id, item_text):
        wanted = [sorted(set(terms(body))) for _, body in group]
        vocabulary = {t: i for i, t in enumerate(sorted({t for item in wanted for t in item}))}
        blocks = written(_blocks(docs, text, doc_id, vocabulary), "blocks")
        results.append(_of_group(blocks, group, wanted, vocabulary, k, item_id, kind))
    if not results:
        return spark.createDataFrame([], "rank int, doc_id bigint, score bigint").select(
            F.lit(None).cast(kind).alias(item_id), "rank", "doc_id", "score"
        )
    return reduce(DataFrame.unionByName, results)


def _of_group(blocks: DataFrame, group, wanted, vocabulary, k: int, item_id: str, kind) -> DataFrame:
    spark = blocks.sparkSession
    totals = blocks.agg(F.sum("documents"), F.sum("length")).first()
    documents, length = int(totals[0] or 0), int(totals[1] or 0)
    holding = np.zeros(len(vocabulary), np.int64)

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        whole = None
        for batch in batches:
            for counts in batch.holding:
                counts = np.frombuffer(counts, np.int64)
                whole = counts if whole is None else whole + counts
        if whole is not None:
            at = np.flatnonzero(whole)
            yield pd.DataFrame({"term": at, "holding": whole[at]})

    # One row a term of this group.
    for row in blocks.select("holding").mapInPandas(add, "term bigint, holding bigint").groupBy("term").agg(F.sum("holding")).toLocalIterator():
        holding[row[0]] = row[1]
    weights = np.array([weight(documents, int(n)) for n in holding], np.int64)
    corpus = Corpus(documents, length, weights)
    numbers = [np.array([vocabulary[t] for t in item], np.int64) for item in wanted]
    found = _searched(blocks, numbers, corpus, k)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = spark.createDataFrame([(i, item[0]) for i, item in enumerate(group)], "item int, name " + kind.simpleString())
    return best.join(names, "item").select(F.col("name").alias(item_id), "rank", "doc_id", "score")
