"""Alignment of two tokenizers' tokens by the bytes that they cover.

Texts are encoded as a space and the text, without special tokens (their strings inside a text are
plain text), by a byte-level BPE (A) and by a sentence-piece model (B), which puts the space there
itself. A token's bytes: A's entry decoded from its byte alphabet; B's piece in UTF-8 with U+2581
as a space, or the byte that a piece like <0x0A> names. Byte offsets at which tokens of both end
cut a document into groups. An A and a B token are linked where their bytes overlap.

A task takes its documents in blocks of about BLOCK bytes and works on the block's Arrow columns:

* tokens of all documents are one flattened list with parent indices, their ends running sums of
  token lengths less the sum at their document's start;
* a full join of A's and B's ends on (document, end) gives every end; those on both sides close a
  group. Between two neighbouring ends lies exactly one link: that of the tokens that cover these
  bytes, the next to end on either side;
* a grouping of the links by document and pair, then by pair, gives in how many of the block's
  documents a pair is linked.

Spark adds up these partial counts, marks each A token's most frequent pairs, and joins them to the
pairs of every block (a pair comes once a block, however often it occurs); the block's documents
get their sums from that. Both tables grow with the input and go by shuffle only.

Words are encoded once, not once an occurrence: both tokenizers give a text the tokens of its pieces where it is
cut before a single space between two other characters (A's pretokens begin there; no piece of B
continues over it, which is checked when it is loaded), so only distinct pieces are run.

Null and empty texts, and texts whose joined A or B bytes differ from space and text, have no
tokens: zeros and an empty string. Repeated rows, and rows with a null doc_id, are documents each.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm import shared, wordcodes

FOLDER = "/opt/tokenizers"
BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: bytes of text handled at once
BLOCK = 1 << 21
#: distinct pieces that a task remembers between its blocks
KNOWN = 300_000
#: bytes of links that a task of the second pass should read
TASK = 32 << 20
_CUT = re.compile(r" (?<=\S )(?=\S)")
_MARK = "▁"
#: a document's bytes take the lower bits of a key, its place in the block the others
_LOW = pa.scalar(40, pa.int64())
# fixed values: the cutting of text into pretokens that the byte-level file names
_PRETOKENS = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable Latin-1 for itself, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Vocabulary:
    """A tokenizer: each id's bytes, and ids of pieces of text."""

    def __init__(self, entries: list[bytes]) -> None:
        self.bytes = pa.array(entries, pa.large_binary())
        self.lengths = pa.array([len(e) for e in entries], pa.int64())
        self.names = pa.array([str(k) for k in range(len(entries))], pa.large_string())

    def __len__(self) -> int:
        return len(self.lengths)


class ByteLevel(Vocabulary):
    """The file's vocabulary is also one of ranks, in the order of its merges: the faster of the two libraries
    for such files gives the same ids (checked for that order), and the other one takes what it cannot."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        with open(path) as file:
            own = json.load(file)
        alphabet = _byte_alphabet()
        ranks = {bytes(alphabet[c] for c in entry): k for entry, k in own["model"]["vocab"].items()}
        entries = [b""] * self.model.get_vocab_size(with_added_tokens=True)
        for entry, k in ranks.items():
            entries[k] = entry
        for added in own["added_tokens"]:
            entries[added["id"]] = entries[added["id"]] or added["content"].encode()
        super().__init__(entries)
        merges = [m.split(" ") if isinstance(m, str) else m for m in own["model"]["merges"]]
        ordered = all(own["model"]["vocab"].get(x + y) == 256 + k for k, (x, y) in enumerate(merges))
        self.ranked = None
        if ordered and own["normalizer"] is None and own["pre_tokenizer"] == _PRETOKENS:
            self.ranked = tiktoken.Encoding("ranks", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, pieces: list[str]) -> list[list[int]]:
        texts = [" " + p for p in pieces]
        if self.ranked:
            try:
                return [self.ranked.encode_ordinary(t) for t in texts]
            except BaseException as error:  # a panic of the library, as for extreme runs of spaces
                if not isinstance(error, Exception) and type(error).__name__ != "PanicException":
                    raise
        return [e.ids for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]


class Pieces(Vocabulary):
    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        entries = [self.model.id_to_piece(k) for k in range(self.model.get_piece_size())]
        if any(_MARK in e.lstrip(_MARK) for e in entries):
            raise ValueError("pieces that continue over a space: words cannot be encoded one by one")
        super().__init__([bytes([int(e[3:5], 16)]) if self.model.is_byte(k) else e.replace(_MARK, " ").encode() for k, e in enumerate(entries)])

    def encode(self, pieces: list[str]) -> list[list[int]]:
        return self.model.encode(pieces, num_threads=1)


def _text(value: str) -> pa.Scalar:
    return pa.scalar(value, pa.large_string())


def _lists(values: list[list[int]]) -> pa.LargeListArray:
    sizes = np.fromiter(map(len, values), np.int64, len(values))
    flat = np.fromiter(chain.from_iterable(values), np.int32, int(sizes.sum()))
    return pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)])), pa.array(flat))


class Encoder:
    """Ids of texts by several vocabularies; distinct pieces are encoded once, and known for later blocks."""

    def __init__(self, vocabularies: list[Vocabulary]) -> None:
        self.vocabularies = vocabularies
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = [_lists([]) for _ in self.vocabularies]

    def __call__(self, texts: list[str]) -> list[pa.LargeListArray]:
        """The ids of every text, a list a text, by each vocabulary."""
        if len(self.known) > KNOWN:
            self._forget()
        parts = [_CUT.split(t) for t in texts]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        known, rows = self.known, []
        for part in parts:
            rows += [known.setdefault(p, len(known)) for p in part]
        have = len(self.ids[0])
        new = list(islice(known, have, None))
        first = np.concatenate([[0], np.cumsum(sizes)])
        out = []
        for k, vocabulary in enumerate(self.vocabularies):
            if new:
                self.ids[k] = pa.concat_arrays([self.ids[k], _lists(vocabulary.encode(new))])
            ids = self.ids[k].take(pa.array(rows, pa.int64()))
            out.append(pa.LargeListArray.from_arrays(ids.offsets.take(pa.array(first)), ids.flatten()))
        return out


def _joined(ids: pa.LargeListArray, entries: pa.Array) -> pa.Array:
    """Each list's entries, one after another."""
    return pc.binary_join(pa.LargeListArray.from_arrays(ids.offsets, entries.take(ids.flatten())), pa.scalar(b"", pa.large_binary()))


def _ends(ids: pa.LargeListArray, lengths: pa.Array) -> tuple[pa.Array, pa.Array]:
    """The document and the end offset of each token, in order."""
    parents = pc.list_parent_indices(ids)
    sums = pc.cumulative_sum(lengths.take(ids.flatten()))
    # the sum at a document's start is that of the token before its first
    before = pa.concat_arrays([pa.array([0], pa.int64()), sums]).take(ids.offsets.slice(0, len(ids)))
    return parents, pc.subtract(sums, before.take(parents))


def aligned(a: pa.LargeListArray, b: pa.LargeListArray, in_a: Vocabulary, in_b: Vocabulary) -> pa.Table:
    """Every link of the documents in text order: doc, end (of the bytes that it covers), the places of
    its tokens in the flattened lists, and if it closes a group. Lists of a document cover the same bytes."""
    sides = []
    for name, ids, vocabulary in (("at_a", a, in_a), ("at_b", b, in_b)):
        doc, end = _ends(ids, vocabulary.lengths)
        # one number as a key: the document above, the end below
        key = pc.bit_wise_or(pc.shift_left(doc, _LOW), end)
        sides.append(pa.table({"key": key, name: pa.array(np.arange(len(doc), dtype=np.int32))}))
    ends = sides[0].join(sides[1], "key", join_type="full outer", use_threads=False).combine_chunks().sort_by("key")
    closes = pc.and_(pc.is_valid(ends["at_a"]), pc.is_valid(ends["at_b"]))
    # both sides end with the document, so the next token to end is one of the same document
    return pa.table({"doc": pc.shift_right(ends["key"], _LOW), "end": pc.bit_wise_and(ends["key"], (1 << _LOW.as_py()) - 1),
                     "at_a": pc.fill_null_backward(ends["at_a"]), "at_b": pc.fill_null_backward(ends["at_b"]), "closes": closes}).combine_chunks()


def _group_lists(ids: pa.LargeListArray, names: pa.Array, last: pa.Array) -> pa.Array:
    """The decimal ids of each group, comma-joined; last: the place of the group's last token."""
    offsets = pa.concat_arrays([pa.array([0], pa.int64()), pc.add(last, 1).cast(pa.int64())])
    return pc.binary_join(pa.LargeListArray.from_arrays(offsets, names.take(ids.flatten())), _text(","))


def groups(links: pa.Table, a: pa.LargeListArray, b: pa.LargeListArray, in_a: Vocabulary, in_b: Vocabulary) -> pa.LargeListArray:
    """The groups of each document, as `a1,a2|b1`."""
    closing = links.filter(links["closes"]).combine_chunks()
    sides = [_group_lists(ids, v.names, closing[at].combine_chunks()) for ids, v, at in ((a, in_a, "at_a"), (b, in_b, "at_b"))]
    written = pc.binary_join_element_wise(*sides, _text("|"))
    of = closing["doc"].to_numpy()
    return pa.LargeListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(len(a) + 1))), written)


SCHEMA = ("block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
          "links binary, pairs array<long>, in_documents array<long>")


def _aligner(folder: str, files: tuple[str, str]):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = Encoder([ByteLevel(f"{folder}/{files[0]}"), Pieces(f"{folder}/{files[1]}")])
        block = TaskContext.get().partitionId() << 32
        for batch, _, _ in wordcodes.chunks(batches, "text", BLOCK):
            yield from _block(block, batch, encode)
            block += 1
    return align


def _block(block: int, batch: pa.RecordBatch, encode: Encoder) -> Iterator[pa.RecordBatch]:
    """The block's documents, their links as numbers of the block's pairs, then one row with these pairs."""
    rows, (in_a, in_b) = batch.num_rows, encode.vocabularies
    texts = pc.fill_null(batch.column("text"), "").cast(pa.large_string())
    a, b = encode(texts.to_pylist())
    spaced = pc.binary_join_element_wise(_text(""), texts, _text(" ")).cast(pa.large_binary())
    right = pc.and_(pc.equal(_joined(a, in_a.bytes), spaced), pc.equal(_joined(b, in_b.bytes), spaced))
    right = pc.and_(right, pc.not_equal(texts, ""))
    place = pc.indices_nonzero(right).to_numpy()
    a, b = (pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(pc.list_value_length(x).to_numpy())])), x.flatten())
            for x in (a.filter(right), b.filter(right)))
    links = aligned(a, b, in_a, in_b)
    pair = pc.add(pc.multiply(a.flatten().take(links["at_a"]).cast(pa.int64()), pa.scalar(len(in_b), pa.int64())), b.flatten().take(links["at_b"]).cast(pa.int64()))
    linked = pa.table({"doc": links["doc"], "pair": pair})
    once = linked.group_by(["doc", "pair"], use_threads=False).aggregate([])
    counted = once.group_by("pair", use_threads=False).aggregate([([], "count_all")]).sort_by([("count_all", "descending"), ("pair", "ascending")])
    number = pc.index_in(linked["pair"], value_set=counted["pair"].combine_chunks()).to_numpy()
    wide = number.astype("<u2" if counted.num_rows <= 1 << 16 else "<u4")

    def spread(values: np.ndarray) -> pa.Array:
        out = np.zeros(rows, np.int64)
        out[place] = values
        return pa.array(out)

    at = np.searchsorted(links["doc"].to_numpy(), np.arange(len(a) + 1))
    written = groups(links, a, b, in_a, in_b)
    digests = [""] * rows
    codes = [b""] * rows
    for k, text in enumerate(pc.binary_join(written, _text(";"))):
        digests[place[k]] = hashlib.sha256(text.as_buffer()).hexdigest()
        codes[place[k]] = wide[at[k]:at[k + 1]].tobytes()
    sizes = [spread(pc.list_value_length(x).to_numpy()) for x in (a, b, written)]
    none = pa.nulls(rows, pa.list_(pa.int64()))
    names = ["block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links", "pairs", "in_documents"]
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.full(rows, block)), batch.column("doc_id").cast(pa.int64()), *sizes, spread(np.diff(at)),
         pa.array(digests, pa.string()), pa.array(codes, pa.binary()), none, none], names)
    empty = [pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())]
    ends = pa.array([0, counted.num_rows], pa.int32())
    yield pa.RecordBatch.from_arrays(
        [pa.array([block]), *empty, *(pa.ListArray.from_arrays(ends, counted[c].combine_chunks()) for c in ("pair", "count_all"))], names)


def _summed(docs: pa.Table, found: pa.Table) -> pa.Table:
    """A block's documents with the sums over their links; found(number, n, best) are the block's pairs."""
    order = np.argsort(found["number"].to_numpy())
    n, best = found["n"].to_numpy()[order], found["best"].to_numpy()[order]
    kind = "<u2" if len(order) <= 1 << 16 else "<u4"
    sums = [[], []]
    for links in docs["links"]:
        number = np.frombuffer(links.as_buffer(), kind)
        sums[0].append(int(best[number].sum()))
        sums[1].append(int(n[number].sum()))
    out = docs.drop_columns(["links"])
    return out.append_column("n_best", pa.array(sums[0], pa.int64())).append_column("count_sum", pa.array(sums[1], pa.int64()))


def align(docs: DataFrame, folder: str = FOLDER, files: tuple[str, str] = (BYTE_LEVEL, PIECES)) -> tuple[DataFrame, DataFrame]:
    """The documents' alignments, and the table of all pairs: a, b, n (documents that hold it linked), best.

    folder: where every executor finds the two vocabulary files.
    """
    spark = docs.sparkSession
    space = shared.workspace(spark, "align")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    both = shared.stored(base.mapInArrow(_aligner(folder, files), SCHEMA), f"{space}/blocks")
    size_b = len(Pieces(f"{folder}/{files[1]}"))
    held = both.filter("pairs IS NOT NULL").select("block", "pairs", "in_documents")
    counts = (held.select(F.explode(F.arrays_zip("pairs", "in_documents")).alias("p")).groupBy(F.col("p.pairs").alias("pair"))
              .agg(F.sum("p.in_documents").alias("n")).withColumn("a", F.expr(f"pair div {size_b}")))
    counts = shared.stored(counts, f"{space}/counts")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    marked = counts.join(most, "a").select("pair", "a", (F.col("pair") % size_b).alias("b"), "n", (F.col("n") == F.col("most")).alias("best"))
    named = held.select("block", F.posexplode("pairs").alias("number", "pair"))
    found = named.join(marked.select("pair", "n", "best"), "pair").select(
        F.col("block").alias("of_block"), "number", "n", F.col("best").cast("int").alias("best"))
    rows = both.filter("pairs IS NULL").drop("pairs", "in_documents")
    size = rows.agg(F.sum(F.length("links"))).first()[0] or 0
    tasks = max(shared.partitions(spark), -(-size // TASK))
    schema = "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    out = (rows.repartition(tasks, "block").groupBy("block").cogroup(found.repartition(tasks, "of_block").groupBy("of_block"))
           .applyInArrow(_summed, schema))
    return out, marked.drop("pair")


def alignments(docs: DataFrame, folder: str = FOLDER) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every document."""
    return align(docs, folder)[0].drop("block")
