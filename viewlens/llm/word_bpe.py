"""BPE encoding and decoding through a table of distinct words.

Words end at ASCII white space, which the vocabulary's own splitting drops and never joins over, so a text's ids are its
words' ids in order; a vocabulary file that does not split there is refused. Blocks of documents send their distinct words, spread by hash; each distinct word is encoded once
where its requests meet; the ids go back to the blocks and are put in place by position. Decoding joins each id to its
piece in the vocabulary's id-to-piece table. The vocabulary file has a fixed size and is sent to every task.

Defined cases: null and empty texts have no ids and decode to the empty text; a word of any length is one word; repeated
rows are encoded alike; a null id is kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from viewlens.llm.blocks import apart, dealt, texts_of
from viewlens.llm.common import coded, give_back, hash_words, ship, split_words

ship(__name__)

BLOCK_BYTES = 4 << 20


def vocabulary_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def id_to_piece(data: bytes) -> dict[int, str]:
    vocabulary = json.loads(data)
    return {i: p for p, i in vocabulary["model"]["vocab"].items()} | {t["id"]: t["content"] for t in vocabulary["added_tokens"]}


def _tokenizer(data: bytes):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_str(data.decode("utf-8"))
    t.no_truncation()
    t.no_padding()
    return t


def check_splitting(data: bytes) -> None:
    """Raises unless a text's ids are its words' ids one after the other, and ids decode to their pieces joined by a space: what the
    table of distinct words relies on."""
    t, pieces = _tokenizer(data), id_to_piece(data)

    def ids(text: str) -> list[int]:
        return t.encode(text, add_special_tokens=False).ids

    loose = [a["content"] for a in json.loads(data)["added_tokens"] if a["lstrip"] or a["rstrip"] or a["content"].split() != [a["content"]]]
    words = ["a", "I", "don't", "'s", "12", "!?", "\u00e9t\u00e9", "e\u0301", "\u4e2d\u6587", "x1y", "\U0001f600", *(p for p in list(pieces.values())[:3] if p.split() == [p])]
    for x in words:
        for y in words:
            for gap in (" ", "\n", "\t \r\n", "\x0b", "\x0c"):
                both = ids(x + gap + y)
                if loose or both != ids(x) + ids(y) or t.decode(both, skip_special_tokens=False) != " ".join(pieces[i] for i in both):
                    raise ValueError("this vocabulary joins over white space, or does not decode to pieces with a space between: "
                                     + repr(loose or x + gap + y))
    if any(ids(gap) for gap in ("", " ", "\n\t ")):
        raise ValueError("this vocabulary has ids for white space")


def _by_part(words: pa.Array, parts: int):
    """(order, ends): words by part and code point, and where each part ends; only the set of words decides it."""
    order = pc.sort_indices(words).to_numpy() if len(words) else np.zeros(0, np.int64)
    part = (hash_words(words) % np.uint64(parts)).astype(np.int64)[order]
    by_part = np.argsort(part, kind="stable")
    return order[by_part], np.searchsorted(part[by_part], np.arange(parts + 1))


def _squeeze(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(data)


def _restore(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data)


def _pack(a: np.ndarray) -> bytes:
    kind = np.dtype(next(k for k in (np.uint8, np.uint16, np.uint32) if a.max(initial=0) <= np.iinfo(k).max))
    return bytes([kind.itemsize]) + _squeeze(a.astype(kind).tobytes())


def _unpack(b: bytes) -> np.ndarray:
    return np.frombuffer(_restore(b[1:]), f"<u{b[0]}").astype(np.int32)


def request(parts: int):
    def run(key, table):
        _, words = coded(split_words(texts_of(table))[1])
        order, ends = _by_part(words, parts)
        rows = [(p, a, b) for p, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)) if b > a]
        return pa.table({"part": pa.array([p for p, _, _ in rows], pa.int32()), "block": pa.array([key[0].as_py()] * len(rows), pa.int32()),
                         "words": pa.array([_squeeze("\n".join(words.take(pa.array(order[a:b])).to_pylist()).encode()) for _, a, b in rows], pa.binary())})
    return run


def answer(data):
    """Encode each distinct word of a part once; per block the number of ids of its words, and the ids."""
    def run(key, table):
        lists = [pc.split_pattern(pa.array([_restore(w)], pa.binary()).cast(pa.string(), safe=False), "\n").values for w in table["words"].to_pylist()]
        codes, distinct = coded(pa.concat_arrays(lists))
        bounds = np.cumsum([0, *map(len, lists)])
        del lists
        give_back()
        tokenizer, ids, count = _tokenizer(data.value), [], []
        for at in range(0, len(distinct), 4096):
            some = [e.ids for e in tokenizer.encode_batch_fast(distinct.slice(at, 4096).to_pylist(), add_special_tokens=False)]
            count.append(np.array([len(x) for x in some], np.int32))
            ids.append(np.array([i for x in some for i in x], np.int32))
        flat, count = np.concatenate(ids), np.concatenate(count)
        start = np.concatenate([[0], np.cumsum(count)])
        out = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            own = codes[a:b]
            n = count[own]
            place = np.repeat(start[own] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            out.append((_pack(n), _pack(flat[place])))
        return pa.table({"block": table["block"], "part": table["part"], "n": pa.array([n for n, _ in out], pa.binary()),
                         "ids": pa.array([i for _, i in out], pa.binary())})
    return run


def _joined(values: pa.Array, offsets: np.ndarray) -> pa.Array:
    """The strings of each run of values joined by a space."""
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), values.cast(pa.large_string())), pa.scalar(" ", pa.large_string()))


def encoded(docs: DataFrame, vocabulary: str, digest=None, schema: str = "n_tokens long, ids array<int>, decoded string"):
    """doc_id, n_tokens and what ``digest`` makes of each document's ids, ids as text, and decoded text (functions)."""
    spark = docs.sparkSession
    check_splitting(vocabulary_bytes(vocabulary))
    data = spark.sparkContext.broadcast(vocabulary_bytes(vocabulary))  # a fixed file of a few MB
    pieces = spark.sparkContext.broadcast(id_to_piece(data.value))
    rows, parts = dealt(docs, block_bytes=BLOCK_BYTES)
    kind = docs.schema["doc_id"].dataType.simpleString()
    asked = rows.groupBy("block").applyInArrow(request(parts), "part int, block int, words binary")
    answers = asked.groupBy("part").applyInArrow(answer(data), "block int, part int, n binary, ids binary")
    finish = digest or lists_of

    def join_back(key, table, got):
        offsets, words = split_words(texts_of(table))
        codes, words = coded(words)
        order, ends = _by_part(words, parts)
        got = got.sort_by("part")
        n = np.concatenate([np.zeros(0, np.int32), *(_unpack(x) for x in got["n"].to_pylist())])
        ids = np.concatenate([np.zeros(0, np.int32), *(_unpack(x) for x in got["ids"].to_pylist())])
        if len(n) != len(words):
            raise ValueError(f"block {key[0]}: {len(words)} words, {len(n)} answers")
        where = np.empty(len(words), np.int64)  # of each word in the answers
        where[order] = np.arange(len(words))
        per_word = np.concatenate([[0], np.cumsum(n)])
        distinct_ids, place = np.unique(ids, return_inverse=True)
        id_text = _joined(pa.array([str(i) for i in distinct_ids.tolist()], pa.string()).take(pa.array(place)), per_word)
        decoded = _joined(pa.array([pieces.value[i] for i in distinct_ids.tolist()], pa.string()).take(pa.array(place)), per_word)
        at = where[codes]
        tokens = n[at]
        some = tokens > 0  # a word without ids leaves no space
        kept = np.concatenate([[0], np.cumsum(some)])[offsets]
        ends = np.concatenate([[0], np.cumsum(tokens, dtype=np.int64)])
        out = {"doc_id": table["doc_id"], "copies": table["copies"], "n_tokens": pa.array(np.diff(ends[offsets]))}
        pick = pa.array(at[some])

        def id_lists():
            flat = ids[np.repeat(per_word[at] - ends[:-1], tokens) + np.arange(ends[-1])]
            return pa.ListArray.from_arrays(pa.array(ends[offsets].astype(np.int32)), pa.array(flat))

        out |= finish(id_lists, lambda: _joined(id_text.take(pick), kept), lambda: _joined(decoded.take(pick), kept))
        del words, got, id_text, decoded, pick
        give_back()
        return pa.table(out)

    return apart(rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(join_back, f"doc_id {kind}, copies long, {schema}"))


def lists_of(id_lists, id_texts, decoded) -> dict:
    return {"ids": id_lists(), "decoded": decoded().cast(pa.string())}


def hashes_of(id_lists, id_texts, decoded) -> dict:
    def sha(a):
        return pa.array([hashlib.sha256(t.encode()).hexdigest() for t in a.to_pylist()], pa.string())
    return {"ids_sha256": sha(id_texts()), "decoded_sha256": sha(decoded())}


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens, ids, decoded: a row per document."""
    return encoded(docs, vocabulary)


def encode_digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: a row per document."""
    return encoded(docs, vocabulary, hashes_of, "n_tokens long, ids_sha256 string, decoded_sha256 string")
