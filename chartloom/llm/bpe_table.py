"""BPE encoding and decoding through a table of distinct words.

Encoding, in four steps:

1. Texts are split into words and counted, in each task first and then over
   all tasks: the distinct-word table.
2. The most frequent words (``hot_words`` at most, none longer than LONG
   characters, so at most about 100 MB in the worst case and some 15 MB in
   practice) are encoded and broadcast. They are nine tenths of all text and
   every hot key.
3. Each other occurrence becomes a row (document, position, word). Rows meet by
   word, each distinct word is encoded once, and its ids go back by document.
4. A document's known ids and its other words' ids are joined by position.

Nothing that grows with the corpus is broadcast or collected, and no word that
is left to step 3 is frequent. Texts that the splitter does not vouch for (see
``tokens``) and words of more than LONG characters are encoded where they stand.

``decode`` joins a table of ids with the table of pieces (id, piece), whose size is
that of the vocabulary: the distinct ids of a batch of documents are rows, meet
their pieces by id, and go back to the batch, where numbers put them in their
places. Pieces are put together by the tokenizer's own decoder if it has one, else
with a space between. The query, which has a document's ids at hand in the task
that made them, meets the same table there (``decode_ids``), as sending all ids
through one more exchange would move more than is allowed.

Edge cases: a null text counts as empty; an empty text has no ids and decodes
to an empty text. Repeated rows (even with equal doc_id) each get their ids. A
null doc_id is kept. Other columns are left out. An empty table gives no row.
"""

from __future__ import annotations

import functools
import hashlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.llm.common import bound_batches, kept, map_arrow, stage
from chartloom.llm.tokens import CODE, LONG, Counts, Encoder, encoder

PATH = public_tokenizers.path("word_bpe_49k.json")


def word_counts(docs: DataFrame, vocabulary: str = PATH, text: str = "text") -> DataFrame:
    """(word, n): the distinct-word table of all texts."""

    def count(batches):
        import pyarrow as pa

        table = Counts(vocabulary)

        def out(words, n):
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(n, pa.int64())], names=["word", "n"])

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                for part in table.read([t for t in batch.column(0).slice(at, 512).to_pylist() if t]):
                    yield out(*part)
        yield out(*table.take())

    return docs.select(F.col(text).cast("string")).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def hot_words(counts: DataFrame, most: int) -> list[str]:
    """The most frequent words, ``most`` at most: all whose count is above a power of 2 ** (1 / 8)."""
    level = F.floor(F.log2("n") * 8).cast("int")
    held = sorted(counts.groupBy(level.alias("level")).agg(F.count("*").alias("k")).collect(), reverse=True)  # some 500 rows at most
    total, least = 0, None
    for level_, k in held:
        total += k
        if total > most:
            break
        least = level_
    return [] if least is None else [r.word for r in counts.filter(level >= least).select("word").collect()]


def encode(docs: DataFrame, vocabulary: str = PATH, most_hot: int = 1 << 19, text: str = "text", finish=None, schema: str = "ids binary") -> DataFrame:
    """(doc_id, ids) of every document, or with finish(ids) -> tuple, (doc_id, *schema)."""
    spark = docs.sparkSession
    keyed = docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("h"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    counts = stage(word_counts(keyed, vocabulary), "words")
    shared = spark.sparkContext.broadcast(Encoder(vocabulary).preset([w.encode(CODE) for w in hot_words(counts, most_hot)]))

    def known():
        import zstandard

        enc, zip_ = kept("hot words", shared.value, lambda held: Encoder(vocabulary, 1).restore(held)), zstandard.ZstdCompressor(level=3)

        def f(batch):
            out = [zip_.compress(x) for x in enc.encode(batch.column("text").to_pylist(), learn=False)]
            return {"doc_id": batch.column("doc_id"), "h": batch.column("h"), "k": [-1] * len(out), "at": [0] * len(out), "ids": out}

        return f

    def others():
        import numpy as np

        enc = kept("hot words", shared.value, lambda held: Encoder(vocabulary, 1).restore(held))

        def f(batch):
            rows, ks, ats, names = [], [], [], []
            for group, _ in enc.groups(batch.column("text").to_pylist()):
                words = enc.split([t for _, t in group])
                numbers = enc.numbers(words, learn=False)
                begins = np.concatenate([[0], np.cumsum(np.where(numbers < 0, 0, enc.count[numbers]))])
                rare = np.flatnonzero((numbers < 0) & (words.length <= LONG))
                doc = np.searchsorted(words.first, rare, "right") - 1
                at = 2 * (begins[rare] - begins[words.first[doc]])
                for d, long in enc.in_place(words).items():
                    for j, own in long:
                        at[(doc == d) & (rare > j)] += len(own)
                rows.append(np.array([i for i, _ in group], "i8")[doc])
                ks.append(np.arange(len(rare)) - np.searchsorted(doc, doc))
                ats.append(at)
                names += [words.word(i).decode(CODE) for i in rare.tolist()]
            taken = np.concatenate(rows)
            return {"doc_id": batch.column("doc_id").take(taken), "h": batch.column("h").take(taken), "k": np.concatenate(ks), "at": np.concatenate(ats), "word": names}

        return f

    def encode_runs():
        enc = encoder(vocabulary)
        last: list = [None, b""]

        def f(batch):
            words = batch.column("word").to_pylist()
            new = list(dict.fromkeys(w for w in words if w != last[0]))
            ids = dict(zip(new, enc.library_ids(new), strict=True))
            ids.setdefault(last[0], last[1])
            out = [ids[w] for w in words]
            last[:] = [words[-1], out[-1]]
            return {**{c: batch.column(c) for c in ("doc_id", "h", "k", "at")}, "ids": out}

        return f

    key = "doc_id long, h long, k int, at int, "
    rest = map_arrow(keyed, key + "word string", others).repartition("word").sortWithinPartitions("word")
    rest = map_arrow(rest, key + "ids binary", encode_runs, rows=4096)
    rows = map_arrow(keyed, key + "ids binary", known).unionByName(rest)
    rows = rows.repartition("doc_id", "h").sortWithinPartitions("doc_id", "h", "k")
    fields = [f.split() for f in schema.split(", ")]

    def merge(batches):
        import pyarrow as pa
        import zstandard

        unzip = zstandard.ZstdDecompressor()
        now, known_, copies, pieces, at, last, done = None, b"", 0, [], 0, -1, []

        def close():
            ids = b"".join([*pieces, known_[at:]])
            row = (ids,) if finish is None else finish(ids)
            done.extend([(now[0], *row)] * copies)

        def flush():
            cols = list(zip(*done, strict=True))
            kinds = {"binary": pa.binary(), "long": pa.int64(), "string": pa.string()}
            arrays = [pa.array(cols[0], pa.int64()), *(pa.array(c, kinds[kind]) for c, (_, kind) in zip(cols[1:], fields, strict=True))]
            done.clear()
            return pa.RecordBatch.from_arrays(arrays, names=["doc_id", *(n for n, _ in fields)])

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("doc_id", "h", "k", "at", "ids")]
            for doc, h, k, where, ids in zip(*cols, strict=True):
                if k < 0:
                    if (doc, h) == now:
                        copies += 1  # the same row again; its other words come that often, too
                        continue
                    if now is not None:
                        close()
                    now, known_, copies, pieces, at, last = (doc, h), unzip.decompress(ids), 1, [], 0, -1
                elif k != last:
                    pieces += [known_[at:where], ids]
                    at, last = where, k
                if len(done) >= 256:
                    yield flush()
        if now is not None:
            close()
        if done:
            yield flush()

    return rows.mapInArrow(merge, "doc_id long, " + schema)


@functools.lru_cache(maxsize=2)
def pieces_of(vocabulary: str) -> tuple[list[str], bool]:
    """Pieces by id, and whether the tokenizer has a decoder of its own."""
    library = encoder(vocabulary).library
    return [library.id_to_token(i) or "" for i in range(library.get_vocab_size(with_added_tokens=True))], library.decoder is not None


def decode_ids(ids: list[int], vocabulary: str = PATH) -> str:
    pieces, decodes = pieces_of(vocabulary)
    found = map(pieces.__getitem__, ids)
    return encoder(vocabulary).library.decoder.decode(list(found)) if decodes else " ".join(found)


def piece_table(spark: SparkSession, vocabulary: str = PATH) -> DataFrame:
    """(id, piece) of the whole vocabulary."""
    size = encoder(vocabulary).library.get_vocab_size(with_added_tokens=True)

    def make():
        pieces, _ = pieces_of(vocabulary)
        return lambda batch: {"id": batch.column("id"), "piece": [pieces[i] for i in batch.column("id").to_pylist()]}

    return map_arrow(spark.range(0, size, 1, 1), "id int, piece string", make, rows=10_000)


def decode(encoded: DataFrame, vocabulary: str = PATH) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids), by an id-to-piece join; null ids give a null text."""
    schema = "batch long, items array<int>, docs array<long>, counts array<int>, numbers binary"

    def split(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            rows = [np.frombuffer(v, "<u2") for v in batch.column(1).to_pylist()]
            items, numbers = np.unique(np.concatenate([np.zeros(0, "<u2"), *rows]), return_inverse=True)
            columns = [pa.array([number], pa.int64()), pa.array([items.astype("i4")], pa.list_(pa.int32())), pa.array([batch.column(0).to_pylist()], pa.list_(pa.int64()))]
            columns += [pa.array([np.array(list(map(len, rows)), "i4")], pa.list_(pa.int32())), pa.array([numbers.astype("<u2").tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["batch", "items", "docs", "counts", "numbers"])
            number += 1

    bound_batches(encoded.sparkSession)
    known = encoded.filter(F.col("ids").isNotNull()).select(F.col("doc_id").cast("long"), "ids")
    held = stage(known.mapInArrow(split, schema), "ids")
    pieces = F.broadcast(piece_table(encoded.sparkSession, vocabulary))  # as large as the vocabulary
    parts = held.select("batch", F.posexplode("items").alias("at", "id")).join(pieces, "id").select("batch", "at", "piece")
    heads = held.select("batch", F.lit(-1).alias("at"), F.lit(None).cast("string").alias("piece"), "docs", "counts", "numbers")
    none = {"docs": F.lit(None).cast("array<long>"), "counts": F.lit(None).cast("array<int>"), "numbers": F.lit(None).cast("binary")}
    rows = heads.unionByName(parts.withColumns(none)).repartition("batch").sortWithinPartitions("batch", "at")

    def assemble(batches):
        import numpy as np
        import pyarrow as pa

        decoder = encoder(vocabulary).library.decoder
        join = " ".join if decoder is None else decoder.decode
        head, spelled = None, []

        def close():
            numbers, cuts = np.frombuffer(head["numbers"], "<u2").tolist(), np.concatenate([[0], np.cumsum(head["counts"])]).astype("i8").tolist()
            texts = [join([spelled[i] for i in numbers[a:b]]) for a, b in zip(cuts, cuts[1:], strict=False)]
            return pa.RecordBatch.from_arrays([pa.array(head["docs"], pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])

        for batch in batches:
            at = batch.column("at").to_numpy()
            cuts = np.unique([0, *np.flatnonzero(at < 0).tolist(), len(at)]).tolist()
            for a, b in zip(cuts, cuts[1:], strict=False):
                if at[a] < 0:
                    if head is not None:
                        yield close()
                    head, spelled = {c: batch.column(c)[a].as_py() for c in ("docs", "counts", "numbers")}, []
                    a += 1
                spelled += batch.column("piece").slice(a, b - a).to_pylist()
        if head is not None:
            yield close()

    null = encoded.filter(F.col("ids").isNull()).select(F.col("doc_id").cast("long"), F.lit(None).cast("string").alias("text"))
    return rows.mapInArrow(assemble, "doc_id long, text string").unionByName(null)


def digests(ids: bytes) -> tuple[int, str, str]:
    import numpy as np

    ids_ = np.frombuffer(ids, "<u2")
    text = decode_ids(ids_.tolist())
    return len(ids_), hashlib.sha256(ids_.astype("<u4")).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


def query(spark, sf_dir: str) -> DataFrame:
    from chartloom.llm.common import table

    docs = table(spark, sf_dir, "documents")
    return encode(docs, finish=digests, schema="n_tokens long, ids_sha256 string, decoded_sha256 string")
