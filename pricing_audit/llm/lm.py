"""Log-probabilities of whole documents under a recurrent language model and a unigram base.

Counts cover every training document. Tasks count the words they read and send partial sums; the
table of all words stays distributed. Only the words above a count threshold, at most
``FREQUENT_WORDS`` of them, are collected and sent to the tasks; the counts of all others are joined.
The network's weights are learnt from every training document, each seen once, by replicas whose
weights are averaged after each round.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import spread, stage
from . import gru
from .common import ship_code, whole_text
from .tokens import _runs

FREQUENT_WORDS = 150_000
REPLICA_TOKENS, MOST_REPLICAS = 4_000_000, 256
ROUNDS = 4
RUN_BYTES = 1 << 23
FLUSH = 300_000
END = b""  # no word is empty
ROWS = (
    "key long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double,"
    " word binary, n long"
)
_FIELDS = [
    ("key", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
    ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()), ("word", pa.binary()),
    ("n", pa.int64()),
]


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id as text leaves 1 modulo 5; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def words_of(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words of the texts, all words as numbers into them, and each text's word count.

    Words are runs of characters other than ASCII white space, A-Z lower-cased.
    """
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    owner = np.repeat(np.arange(len(texts)), np.diff(parts.offsets.to_numpy().astype(np.int64)))
    coded = parts.flatten().dictionary_encode()
    distinct = coded.dictionary.cast(pa.binary()).to_pylist()
    which = coded.indices.to_numpy().astype(np.int64)
    if END in distinct:  # where a text begins or ends with white space
        real = which != distinct.index(END)
        which, owner = which[real], owner[real]
    return distinct, which, np.bincount(owner, minlength=len(texts)).astype(np.int64)


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over the training documents; the end token stands under the empty word.

    A task adds up what it reads and passes it on whenever it holds ``FLUSH`` words.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], ["word", "n"]
            )
            held.clear()
            return made

        for batch in batches:
            for run in _runs(batch.column(0), RUN_BYTES):
                distinct, which, _ = words_of(run)
                sums = np.bincount(which, minlength=len(distinct)).tolist()
                for word, n in zip(distinct, sums, strict=True):
                    if n:
                        held[word] = held.get(word, 0) + n
                held[END] = held.get(END, 0) + len(run)
                if len(held) > FLUSH:
                    yield out()
        yield out()

    known = docs.filter(~held_out(F.col("doc_id"))).select("text")
    return known.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """What tasks need of the counts: sums, the frequent words, and the tail classes' sums."""

    tokens: int
    words: int
    number: dict[bytes, int]  # of each frequent word, by falling count
    counts: np.ndarray
    tail_tokens: np.ndarray
    tail_words: np.ndarray

    def __post_init__(self):
        self.ids = np.array(
            [i if i < gru.HEAD else gru.HEAD + gru.tail_class(w) for w, i in self.number.items()], np.int64
        )
        self.log_count = np.log10(self.counts + 0.5)
        self.log_tail = np.log10(self.tail_tokens + 0.5 * (self.tail_words + 1))
        self.log_all = np.log10(self.tokens + 0.5 * (self.words + 1))

    def encode(self, distinct: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids for the model; log10 of count + 1/2 and whether it is known, 0 and False if rare."""
        number = np.fromiter((self.number.get(w, -1) for w in distinct), np.int64, len(distinct))
        frequent = number >= 0
        if not len(self.ids):
            ids, log_count = np.zeros(len(number), np.int64), np.zeros(len(number))
        else:
            ids = self.ids[np.maximum(number, 0)]
            log_count = np.where(frequent, self.log_count[np.maximum(number, 0)], 0.0)
        rare = np.flatnonzero(~frequent)
        ids[rare] = [gru.HEAD + gru.tail_class(distinct[i]) for i in rare.tolist()]
        return ids, log_count, frequent


def _tail_of(word: str) -> Column:
    """gru.tail_class as a column expression."""
    ending = F.substring(F.col(word).cast("string"), -2, 2)
    return (F.crc32(ending.cast("binary")) % gru.TAIL_CLASSES).cast("int")


def vocabulary(counts: DataFrame) -> tuple[Vocabulary, int]:
    """The vocabulary, and the least count of a frequent word (every word with it is frequent).

    A histogram with eight bins per doubling picks the threshold, so the bound holds whatever the
    counts; tail sums come back as one row per class.
    """
    size = F.floor(F.log2("n") * 8).cast("int")
    bins = sorted(
        ((r["bin"], r["words"], r["tokens"], r["least"]) for r in counts.groupBy(size.alias("bin")).agg(
            F.count("*").alias("words"), F.sum("n").alias("tokens"), F.min("n").alias("least")
        ).collect()), reverse=True,
    )
    taken, least = 0, 1 << 62
    for _, words, _, smallest in bins:
        taken += words
        if taken > FREQUENT_WORDS:
            break
        least = smallest
    table = counts.filter(F.col("n") >= least).toArrow().sort_by([("n", "descending"), ("word", "ascending")])
    frequent, amounts = table["word"].to_pylist(), table["n"].to_numpy()
    tail_tokens, tail_words = np.zeros(gru.TAIL_CLASSES), np.zeros(gru.TAIL_CLASSES)
    rare = counts.filter(F.col("n") < least).groupBy(_tail_of("word").alias("tail")).agg(
        F.sum("n").alias("tokens"), F.count("*").alias("words")
    )
    for r in rare.collect():
        tail_tokens[r["tail"]], tail_words[r["tail"]] = r["tokens"], r["words"]
    for word, n in zip(frequent[gru.HEAD :], amounts[gru.HEAD :].tolist(), strict=True):
        tail_tokens[gru.tail_class(word)] += n
        tail_words[gru.tail_class(word)] += 1
    made = Vocabulary(
        sum(b[2] for b in bins), sum(b[1] for b in bins), {w: i for i, w in enumerate(frequent)},
        amounts.astype(np.int64), tail_tokens, tail_words,
    )
    return made, least


def _documents(texts: pa.Array, words: Vocabulary) -> Iterator[np.ndarray]:
    """Each text's ids for the model, end included."""
    end = words.encode([END])[0]
    for run in _runs(texts, RUN_BYTES):
        distinct, which, lengths = words_of(run)
        ids = words.encode(distinct)[0][which] if len(which) else which
        for own in np.split(ids, np.cumsum(lengths)[:-1]):
            yield np.concatenate((own, end))


def train(docs: DataFrame, words: Vocabulary) -> dict[str, np.ndarray]:
    """Weights learnt on all training documents, averaged over replicas."""
    spark = docs.sparkSession
    model = gru.start_model(words.counts[: gru.HEAD], words.tail_tokens)
    if not words.tokens:
        return model
    replicas = min(MOST_REPLICAS, -(-words.tokens // REPLICA_TOKENS))
    sent = spark.sparkContext.broadcast(words)
    known = docs.filter(~held_out(F.col("doc_id")))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [d.astype("<u2").tobytes() for d in _documents(batch.column(0), sent.value)]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(ids, pa.binary())], ["lot", "ids"])

    lot = F.xxhash64("doc_id", F.lit("lot"), "text").alias("lot")
    encoded = stage(known.select("text", lot).mapInArrow(encode, "lot long, ids binary"), "lm-training")
    speed = gru.fresh_speed(model)
    for number in range(ROUNDS):
        now = spark.sparkContext.broadcast(pickle.dumps((model, speed)))

        def learn(batches: Iterator[pa.RecordBatch], now=now) -> Iterator[pa.RecordBatch]:
            own, fast = pickle.loads(now.value)
            texts = (
                np.frombuffer(ids.as_buffer(), "<u2").astype(np.int64) for b in batches for ids in b.column(0)
            )
            seen = gru.train(own, fast, texts)
            if seen:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([seen], pa.int64()), pa.array([pickle.dumps((own, fast))], pa.binary())], ["seen", "w"]
                )

        def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, sums = 0, None
            for batch in batches:
                for seen, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    parts = [{k: v * np.float32(seen) for k, v in part.items()} for part in pickle.loads(w)]
                    sums = parts if sums is None else [{k: a[k] + b[k] for k in a} for a, b in zip(sums, parts, strict=True)]
                    total += seen
            if sums is not None:
                mean = [{k: v / np.float32(total) for k, v in part.items()} for part in sums]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([total], pa.int64()), pa.array([pickle.dumps(mean)], pa.binary())], ["seen", "w"]
                )

        part = encoded.filter(F.pmod("lot", F.lit(ROUNDS)) == number)
        replica = F.pmod(F.shiftright("lot", 8), F.lit(replicas)).cast("int")
        learnt = (
            part.repartitionById(replicas, replica).sortWithinPartitions("lot").select("ids")
            .mapInArrow(learn, "seen long, w binary")
        )
        rows = learnt.repartition(1).mapInArrow(average, "seen long, w binary").collect()
        if rows:
            model, speed = pickle.loads(rows[0]["w"])
        now.destroy()
    return model


def score_documents(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    A null text is empty and consists of the end token. Null ids count as training documents, and
    repeated rows count and are scored each time. Without any training text every word is unseen
    and the base gives 0. Empty input gives no rows. Only doc_id and text are read.
    """
    ship_code(docs.sparkSession)
    spark = docs.sparkSession
    docs = spread(docs.select("doc_id", "text")).select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    counts = stage(word_counts(docs), "word-counts")
    words, least = vocabulary(counts)
    model = train(docs, words)
    sent = spark.sparkContext.broadcast((words, model))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, model = sent.value
        number = TaskContext.get().partitionId() << 40
        end_id, end_log, end_known = words.encode([END])
        for batch in batches:
            at = 0
            for run in _runs(batch.column(2), RUN_BYTES):
                names, held = batch.column(0).slice(at, len(run)), batch.column(1).slice(at, len(run))
                at += len(run)
                distinct, which, lengths = words_of(run)
                ids, log_count, known = words.encode(distinct)
                owner = np.repeat(np.arange(len(run)), lengths)
                count = lambda mask, owner=owner, n=len(run): np.bincount(owner[mask], minlength=n)
                own = ids[which]
                tail = own >= gru.HEAD
                logs = log_count[which]
                base = np.bincount(owner, logs, len(run)).astype(float) + end_log[0] - (lengths + 1) * words.log_all
                inside = np.where(tail, logs - words.log_tail[np.maximum(own - gru.HEAD, 0)], 0.0)
                total = np.bincount(owner, inside, len(run)).astype(float)
                if end_id[0] >= gru.HEAD:
                    total += end_log[0] - words.log_tail[end_id[0] - gru.HEAD]
                texts = [np.concatenate((d, end_id)) for d in np.split(own, np.cumsum(lengths)[:-1])]
                total += gru.score(model, texts) / np.log(10)
                n_known = count(known[which]) + int(end_known[0])
                keys = np.arange(number, number + len(run))
                number += len(run)
                rare = np.flatnonzero(~known[which])
                pair, times = np.unique(owner[rare] * len(distinct) + which[rare], return_counts=True)
                yield _rows(
                    key=keys, doc_id=names, held_out=held, n_tokens=lengths + 1, n_known=n_known,
                    base=base, score=total,
                )
                if not end_known[0]:  # only without training texts
                    yield _rows(key=keys, word=[END] * len(keys), n=np.ones(len(keys), np.int64))
                if len(pair):
                    spelled = pa.array(distinct, pa.binary()).take(pa.array(pair % len(distinct)))
                    yield _rows(key=keys[pair // len(distinct)], word=spelled, n=times)

    rows = stage(
        docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(judge, ROWS),
        "lm-rows",
    )
    rare = rows.filter("word is not null").select("key", "word", "n")
    of_rare = counts.filter(F.col("n") < least).select("word", F.col("n").alias("c"))
    sums = (
        rare.join(of_rare, "word", "left").groupBy("key").agg(
            F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("more"),
            F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("also"),
        )
    )
    return (
        rows.filter("word is null").join(sums, "key", "left").select(
            "doc_id", "held_out", "n_tokens",
            (F.col("n_known") + F.coalesce("also", F.lit(0))).alias("n_known"),
            F.lit(words.tokens).cast("long").alias("train_tokens"),
            (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
            (F.col("score") + F.coalesce("more", F.lit(0.0))).alias("score"),
        )
    )


def _rows(**columns) -> pa.RecordBatch:
    """A batch of ``ROWS`` with null where no column is given."""
    n = len(columns["key"])
    return pa.RecordBatch.from_arrays(
        [
            pa.nulls(n, kind) if name not in columns else columns[name] if isinstance(columns[name], pa.Array)
            else pa.array(columns[name], kind) for name, kind in _FIELDS
        ],
        [name for name, _ in _FIELDS],
    )
