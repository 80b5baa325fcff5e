"""SentencePiece encoding and decoding over a table of distinct marked words.

White space becomes a marker that can only stand at the start of a piece, so no piece reaches from
one marked word into the next. Each distinct marked word is segmented once in the corpus; its ids
are joined back by position and framed by the begin and end ids. See ``chunks`` for the join. The
vocabulary is checked for pieces that cross markers; with such pieces a text is one chunk, so the
result stays exact. Decoding is the library's, on each document's whole ids.

Defined results: a null text is the empty text (begin and end id only, decoded to the empty text);
repeated rows are encoded each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from paxflow.llm.chunks import over_chunks

MARK = "▁"


@functools.cache
def processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@functools.cache
def crossing(path: str) -> bool:
    """Whether a piece has a marker after another character, or the model changes blanks itself."""
    model = processor(path)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    return any(MARK in p.lstrip(MARK) for p in pieces) or model.encode("a  b ") != (
        model.encode("a") + model.encode(" b ")
    )


def marked_words(text: str) -> list[str]:
    """Chunks that, encoded one by one, give the ids of the text. Each starts at a marker.

    Extra blanks go to the word they precede, blanks at the end to the last word.
    """
    if not text:
        return []
    if MARK in text:
        return [text]
    words = text.split(" ")
    if "" not in words:
        return words
    out, blanks = [], 0
    for word in words:
        if word:
            out.append(" " * blanks + word)
            blanks = 0
        else:
            blanks += 1
    if blanks and out:
        out[-1] += " " * blanks
    elif blanks:
        out.append(" " * (blanks - 1))
    return out


def encode_texts(
    docs: DataFrame,
    path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    ids: bool = False,
) -> DataFrame:
    """Per row: ``doc_id, n_tokens, ids_sha256, decoded_sha256``; with ``ids`` also the ids and the
    decoded text."""

    def split(text: str) -> list[str]:
        return [text] * bool(text) if crossing(path) else marked_words(text)

    def work(chunks: list[str]) -> list[bytes]:
        return [np.array(x, "<u4").tobytes() for x in processor(path).encode(chunks, num_threads=1)]

    def finish(doc_ids, lengths, runs, times, n_bytes, values) -> pa.Table:
        model = processor(path)
        frame = [np.array([x], "<u4").tobytes() for x in (model.bos_id(), model.eos_id())]
        sizes, digests, texts, lists, at = [], [], [], [], 0
        numbers = runs.tolist()
        for n in lengths.tolist():
            body = b"".join(map(values.__getitem__, numbers[at : at + n]))
            at += n
            raw = frame[0] + body + frame[1]
            own = np.frombuffer(raw, "<u4").tolist()
            text = model.decode(own)
            sizes.append(len(own))
            digests.append(hashlib.sha256(raw).hexdigest())
            texts.append(text if ids else hashlib.sha256(text.encode()).hexdigest())
            if ids:
                lists.append(own)
        hashed = texts if not ids else [hashlib.sha256(t.encode()).hexdigest() for t in texts]
        columns = {
            "doc_id": doc_ids,
            "n_tokens": pa.array(sizes, pa.int64()),
            "ids_sha256": pa.array(digests, pa.string()),
            "decoded_sha256": pa.array(hashed, pa.string()),
        }
        if ids:
            columns["ids"] = pa.array(lists, pa.list_(pa.int32()))
            columns["decoded"] = pa.array(texts, pa.string())
        return pa.table(columns)

    output = [("n_tokens", "long"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    if ids:
        output += [("ids", "array<int>"), ("decoded", "string")]
    return over_chunks(docs, id_column, text_column, split, work, finish, output)
