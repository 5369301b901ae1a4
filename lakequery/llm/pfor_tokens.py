"""Token ids in patched frame-of-reference blocks.

A file image holds ids in blocks of 128: each subtracts its minimum and packs the differences at the bit width of their 90th
percentile; wider ones go to the block's exception list whole. The image starts with a magic word, the number of ids and of blocks, and
the byte at which each block starts, so any id can be read alone.

The tokenizer cuts a text before each single space between two non-space characters whatever else it does, so texts are cut there
first, each distinct piece is encoded once in a worker, and the ids are put together by their places. A text that holds a special token
is encoded whole, as the token is one id wherever it stands."""

from __future__ import annotations

import json
import re
import zlib
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lakequery.llm.common import bounded, ids_of, materialize, slices, small_batches

BLOCK = 128
PERCENTILE = 0.9
MAGIC = 0x31524650
HEAD = 7
#: Distinct pieces a worker remembers; with more it starts anew before the next texts.
REMEMBERED = 1_000_000
END_ID = 0
#: Images whose places are broadcast at most, at 16 bytes each; those of more are joined by shuffle.
BROADCAST_IMAGES = 500_000
#: Mark the first piece of a text, its end, and other pieces with no space before them; texts that hold one are encoded whole.
FIRST, LAST, BARE = "\ue000", "\ue001", "\ue002"
MARKS = {FIRST, BARE}


def encode_blocks(ids: np.ndarray) -> bytes:
    """The file image of ids (unsigned 32-bit)."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    counts = np.full(blocks, BLOCK)
    if n % BLOCK:
        counts[-1] = n % BLOCK
    v = np.zeros((blocks, BLOCK), dtype=np.int64)
    v.ravel()[:n] = ids
    if n % BLOCK:
        v[-1, n % BLOCK :] = v[-1, 0]
    least = v.min(axis=1, initial=2**32) if blocks else np.zeros(0, dtype=np.int64)
    v -= least[:, None]
    at = int(np.ceil(PERCENTILE * BLOCK)) - 1
    width = np.ceil(np.log2(np.partition(v, at, axis=1)[:, at] + 1.0)).astype(np.int64) if blocks else np.zeros(0, dtype=np.int64)
    row, col = np.nonzero(v >> width[:, None])
    patches = np.bincount(row, minlength=blocks)
    sizes = HEAD + width * (BLOCK // 8) + 5 * patches
    starts = 12 + 4 * blocks + np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    out = np.zeros(int(starts[-1]), dtype=np.uint8)
    out[:12] = np.array([MAGIC, n, blocks], dtype="<u4").view(np.uint8)
    out[12 : 12 + 4 * blocks] = starts[:-1].astype("<u4").view(np.uint8)
    starts = starts[:-1]
    head = np.zeros((blocks, HEAD), dtype=np.uint8)
    head[:, :4] = least.astype("<u4").view(np.uint8).reshape(-1, 4)
    head[:, 4], head[:, 5], head[:, 6] = width, patches, counts
    out[starts[:, None] + np.arange(HEAD)] = head
    for w in np.unique(width[width > 0]):
        mine = np.flatnonzero(width == w)
        for part in np.array_split(mine, max(1, len(mine) // 512)):
            bits = ((v[part][:, :, None] >> np.arange(w)) & 1).astype(np.uint8).reshape(len(part), -1)
            out[(starts[part] + HEAD)[:, None] + np.arange(w * (BLOCK // 8))] = np.packbits(bits, axis=1, bitorder="little")
    if len(row):
        within = np.arange(len(row)) - np.repeat(np.cumsum(patches) - patches, patches)
        base = starts[row] + HEAD + width[row] * (BLOCK // 8)
        out[base + within] = col
        out[(base + patches[row] + 4 * within)[:, None] + np.arange(4)] = v[row, col].astype("<u4").view(np.uint8).reshape(-1, 4)
    return out.tobytes()


def decode_blocks(image: bytes) -> np.ndarray:
    """All ids of a file image."""
    b = np.frombuffer(image, dtype=np.uint8)
    magic, n, blocks = b[:12].view("<u4")
    if magic != MAGIC:
        raise ValueError("not a token file")
    starts = b[12 : 12 + 4 * int(blocks)].view("<u4").astype(np.int64)
    head = b[starts[:, None] + np.arange(HEAD)]
    least, width, patches = np.ascontiguousarray(head[:, :4]).view("<u4").ravel().astype(np.int64), head[:, 4].astype(np.int64), head[:, 5].astype(np.int64)
    v = np.zeros((int(blocks), BLOCK), dtype=np.int64)
    for w in np.unique(width[width > 0]):
        mine = np.flatnonzero(width == w)
        for part in np.array_split(mine, max(1, len(mine) // 512)):
            packed = b[(starts[part] + HEAD)[:, None] + np.arange(w * (BLOCK // 8))]
            bits = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(part), BLOCK, w)
            v[part] = bits @ (1 << np.arange(w, dtype=np.int64))
    row = np.repeat(np.arange(int(blocks)), patches)
    if len(row):
        within = np.arange(len(row)) - np.repeat(np.cumsum(patches) - patches, patches)
        base = starts[row] + HEAD + width[row] * (BLOCK // 8)
        v[row, b[base + within]] = np.ascontiguousarray(b[(base + patches[row] + 4 * within)[:, None] + np.arange(4)]).view("<u4").ravel()
    return (v + least[:, None]).ravel()[: int(n)].astype(np.uint32)


class Pieces:
    """A tokenizer that encodes each distinct piece once. Pieces hold for byte-level tokenizers whose own pattern cuts texts and that change no text before;
    any other one gets whole texts."""

    CUT = re.compile(r"(?<=\S) (?=\S)")
    #: A space beside other white space or at an end; only then is a space no cut.
    ODD = r"^ | $| [\t-\r\x1c-\x20\x{85}\p{Z}]|[\t-\r\x1c-\x1f\x{85}\p{Z}] "
    #: Further places where a text is cut whatever else it does: after a lone line end, and before punctuation that follows a letter or a digit.
    MORE = ((r"([^\t-\r\x1c-\x20\x{85}\p{Z}])\n([^\t-\r\x1c-\x20\x{85}\p{Z}])", f"\\1\n {BARE}\\2"), (r"([\p{L}\p{N}])([.,;:!?])", f"\\1 {BARE}\\2"))
    END, NONE = 0, 1  # codes of the end id alone and of no id

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        cut = json.loads(self.tokenizer.pre_tokenizer.__getstate__()) if self.tokenizer.pre_tokenizer is not None else {}
        self.cuts = self.tokenizer.normalizer is None and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space", True)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.opens = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.opens[i] = token.startswith("Ġ")  # how the vocabulary writes a space
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {FIRST: self.NONE, LAST: self.END}
        self.ids, self.starts = np.array([END_ID], dtype=np.uint32), np.array([0, 1, 1], dtype=np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each with the end id, and how many each has."""
        if len(self.place) > REMEMBERED:
            self._forget()
        whole = pc.match_substring_regex(texts, f"[{FIRST}{LAST}{BARE}]") if self.cuts else pa.array(np.ones(len(texts), dtype=bool))
        for token in self.special:  # such a token is one id wherever it stands
            whole = pc.or_(whole, pc.match_substring(texts, token))
        odd = pc.and_not(pc.match_substring_regex(texts, self.ODD), whole)
        apart = pc.or_(odd, whole)
        plain = pc.if_else(apart, "", texts)
        for pattern, cut in self.MORE:
            plain = pc.replace_substring_regex(plain, pattern, cut)
        parts = pc.split_pattern(pc.binary_join_element_wise(FIRST, plain, f" {LAST}", ""), " ")
        pieces = parts.flatten().dictionary_encode()
        codes = pa.array(self._codes(pieces.dictionary.to_numpy(zero_copy_only=False).tolist())).take(pieces.indices)
        lists = pa.ListArray.from_arrays(parts.offsets, codes)
        if pc.any(apart).as_py():  # those were taken as empty; they stand after the others and are fetched from there
            cut = [self.CUT.split(t) for t in texts.filter(odd).to_pylist()]
            for c in cut:
                c[0] = " " + c[0]  # marks the first; no other piece starts with a space
                c.append(LAST)
            each = pa.array(chain.from_iterable(cut), pa.string()).dictionary_encode()
            known = self._codes(each.dictionary.to_pylist())[each.indices.to_numpy()]
            alone = self._add(*self._whole(texts.filter(whole).to_pylist()))
            both = np.concatenate([known, np.stack([alone, np.full(len(alone), self.END)], axis=1).ravel()])
            ends = np.concatenate([[0], np.cumsum([*map(len, cut), *[2] * len(alone)])]).astype(np.int32)
            place = np.arange(len(texts))
            is_odd, is_whole = (x.to_numpy(zero_copy_only=False) for x in (odd, whole))
            place[is_odd] = len(texts) + np.arange(len(cut))
            place[is_whole] = len(texts) + len(cut) + np.arange(len(alone))
            lists = pa.concat_arrays([lists, pa.ListArray.from_arrays(pa.array(ends), pa.array(both))]).take(pa.array(place))
        codes = lists.flatten()
        size = np.diff(self.starts)[codes.to_numpy()]
        total = np.concatenate([[0], np.cumsum(size)])
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
        ids = pa.ListArray.from_arrays(pa.array(self.starts.astype(np.int32)), pa.array(self.ids)).take(codes).flatten()
        return ids.to_numpy(), np.diff(total[ends])

    def _codes(self, pieces: list[str]) -> np.ndarray:
        """Codes of distinct pieces; new ones are learnt."""
        codes = np.fromiter(map(self.place.get, pieces, repeat(-1)), dtype=np.int64, count=len(pieces))
        new = np.flatnonzero(codes < 0)
        if len(new):
            learnt = [pieces[i] for i in new.tolist()]
            alone = np.fromiter((p[:1] in MARKS or " " in p for p in learnt), dtype=bool, count=len(learnt))
            order = np.concatenate([new[~alone], new[alone]])
            codes[order] = self._learn([pieces[i] for i in new[~alone].tolist()], [pieces[i] for i in new[alone].tolist()])
            self.place.update(zip(learnt, codes[new].tolist(), strict=True))
        return codes

    def _add(self, ids: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
        """Codes of new pieces, whose ids follow each other in ids."""
        first = len(self.starts) - 1
        self.ids = np.concatenate([self.ids, *ids])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes, dtype=np.int64)])
        return np.arange(first, first + len(sizes))

    def _whole(self, texts: list[str]) -> tuple[list[np.ndarray], list[int]]:
        ids = [np.array(e.ids, dtype=np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return ids, [len(x) for x in ids]

    def _learn(self, plain: list[str], other: list[str]) -> np.ndarray:
        """Codes of new pieces: plain ones after a space each, and others by themselves."""
        groups = [plain[i : i + 256] for i in range(0, len(plain), 256)]
        ids, sizes = [], []
        for group, e in zip(groups, self.tokenizer.encode_batch_fast([" " + " ".join(g) for g in groups], add_special_tokens=False), strict=True):
            got = np.array(e.ids, dtype=np.uint32)
            first = np.flatnonzero(self.opens[got])
            if len(first) == len(group) and first[0] == 0:
                ids.append(got)
                sizes.append(np.diff(first, append=len(got)))
            else:  # not every piece opens with a space of its own, so each by itself
                more = self._whole([" " + p for p in group])
                ids += more[0]
                sizes.append(more[1])
        more = self._whole([p[1:] if p[0] == " " or p[0] in MARKS else " " + p for p in other])
        return self._add(ids + more[0], np.concatenate([*sizes, np.array(more[1], dtype=np.int64)]))


_HELD: dict[str, Pieces] = {}


def _write(path: str):
    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path not in _HELD:
            _HELD[path] = Pieces(path)
        part, segment = TaskContext.get().partitionId(), 0
        for b in slices(batches):
            ids, sizes = _HELD[path].encode(pc.fill_null(b.column(b.schema.get_field_index("text")).cast(pa.string()), ""))
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([segment], pa.int32()), pa.array([len(ids)], pa.int64()), pa.array([ids_of(b, "doc_id")], pa.list_(pa.int64())), pa.array([sizes.tolist()], pa.list_(pa.int64())), pa.array([encode_blocks(ids)], pa.binary())],
                names=["part", "segment", "n_ids", "doc_ids", "sizes", "image"],
            )
            segment += 1

    return bounded(run)


def write_tokens(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write the ids of all documents, ascending doc_id (null first; ties by the text's hash), and return the table of file images:
    part and segment (their order), n_ids, doc_ids, sizes (ids of each document with its end), image.

    A null or empty text is its end id alone. Rows that share a doc_id are written each. Other columns are ignored."""
    small_batches(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    ordered = source.repartitionByRange(F.asc_nulls_first("doc_id"), F.asc("h")).sortWithinPartitions(F.asc_nulls_first("doc_id"), "h")
    return materialize(ordered.select("doc_id", "text").mapInArrow(_write(tokenizer_path), "part int, segment int, n_ids long, doc_ids array<long>, sizes array<long>, image binary"), "pfor-files")


@bounded
def _read(batches):
    for b in batches:
        for k in range(b.num_rows):
            row = {c: b.column(i)[k] for i, c in enumerate(b.schema.names)}
            ids = decode_blocks(row["image"].as_py())
            sizes = row["sizes"].values.to_numpy()
            ends = np.cumsum(sizes)
            raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
            crc = [zlib.crc32(raw[4 * (e - s) : 4 * e]) for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([row["doc_ids"].values, pa.array(ends - sizes + row["before"].as_py()), pa.array(sizes), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def read_tokens(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the file images. Images are numbered within their part; one row for each part is
    ordered in one task. No image is shuffled while their places are few enough to broadcast."""
    places = files.select("part", "segment", "n_ids")
    inside = F.sum("n_ids").over(W.partitionBy("part").orderBy("segment").rowsBetween(W.unboundedPreceding, 0)) - F.col("n_ids")
    parts = places.groupBy(F.col("part").alias("pp")).agg(F.sum("n_ids").alias("t"))
    parts = parts.select("pp", (F.sum("t").over(W.orderBy("pp").rowsBetween(W.unboundedPreceding, 0)) - F.col("t")).alias("ahead"))
    before = places.select(F.col("part").alias("bp"), F.col("segment").alias("bs"), inside.alias("inside")).join(parts, F.col("bp") == F.col("pp")).select("bp", "bs", (F.col("inside") + F.col("ahead")).alias("before"))
    if files.select("part").count() <= BROADCAST_IMAGES:
        before = F.broadcast(before)
    found = files.join(before, (F.col("part") == F.col("bp")) & (F.col("segment") == F.col("bs")))
    return found.select("doc_ids", "sizes", "image", "before").mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")
