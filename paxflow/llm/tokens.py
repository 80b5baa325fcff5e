"""Token counts without token ids: pieces are counted once per distinct pre-token.

The byte-level tokenizer cuts a text at every blank that has no white space beside it, whatever
follows, so what lies between two such blanks (one or a few of its pre-tokens) is counted once in
the corpus, joined to the documents' frequencies and summed. See ``chunks`` for the join.

Defined results: a null text has no tokens; the tokenizer's own special strings inside a text are
special, as in the library's default; repeated rows are counted each; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import functools
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from paxflow.llm.chunks import over_chunks

#: A blank without white space on either side: no pre-token reaches across it.
CUT = re.compile(r" (?<!\s )(?!\s)")
#: White space that is neither a blank nor the end of a line.
RARE = re.compile(r"[^\S \n]")
#: Marks a chunk at a start (of the text or after a special string), where no blank goes before.
START = "\x01"


@functools.cache
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.cache
def special_strings(path: str) -> re.Pattern | None:
    added = tokenizer(path).get_added_tokens_decoder().values()
    words = sorted((re.escape(t.content) for t in added), key=len, reverse=True)
    return re.compile("(" + "|".join(words) + ")") if words else None


def _cut(text: str) -> list[str]:
    """``CUT.split``; where no blank stands beside white space, all blanks are cuts."""
    if "  " in text or " \n" in text or "\n " in text or RARE.search(text):
        return CUT.split(text)
    return text.split(" ")


def pre_tokens(text: str, path: str) -> list[str]:
    """The chunks of a text; a chunk without ``START`` stands after a blank that belongs to it."""
    if not text:
        return []
    if START in text:
        return [START + text]
    special = special_strings(path)
    if special is not None and special.search(text):
        out = []
        for piece in special.split(text):
            if piece:
                chunks = _cut(piece)
                out += [START + chunks[0], *chunks[1:]]
        return out
    chunks = _cut(text)
    chunks[0] = START + chunks[0]
    return chunks


def encoded(chunks: list[str], path: str):
    whole = [c[1:] if c.startswith(START) else " " + c for c in chunks]
    return tokenizer(path).encode_batch_fast(whole, add_special_tokens=False)


#: Letters below this are letters in every version of Unicode's tables.
LATIN_END = "\u0250"


@functools.cache
def _byte_level(path: str) -> dict[int, str]:
    """How the library writes blank and Latin letters before it merges them, asked of it."""
    before = tokenizer(path).pre_tokenizer
    letters = [" ", *(c for c in map(chr, range(ord(LATIN_END))) if c.isalpha())]
    return {ord(c): "".join(x for x, _ in before.pre_tokenize_str(c)) for c in letters}


def _ids_of(chunks: set[str], path: str) -> dict[str, bytes]:
    """Ids of new chunks. A blank, Latin letters and perhaps a stop or comma are two pre-tokens: the
    library's merges are asked directly, once per word; other chunks go through all of it."""
    model, written = tokenizer(path).model, _byte_level(path)
    ends = {mark: np.array([model.token_to_id(mark)], "<u4").tobytes() for mark in ".,"}
    words: dict[str, bytes] = {}
    out, rest = {}, []
    for chunk in chunks:
        end = ends.get(chunk[-1:], b"")
        word = chunk[:-1] if end else chunk
        if not word.isalpha() or not (word.isascii() or max(word) < LATIN_END):
            rest.append(chunk)
            continue
        ids = words.get(word)
        if ids is None:
            found = model.tokenize((" " + word).translate(written))
            ids = words[word] = b"".join([x.id.to_bytes(4, "little") for x in found])
        out[chunk] = ids + end
    out.update(zip(rest, (np.array(e.ids, "<u4").tobytes() for e in encoded(rest, path))))
    return out


#: Chunks whose ids a worker remembers as used of late, as many older ones being at hand; and the
#: longest chunk that is remembered, which bounds the memory in bytes.
REMEMBERED, LONGEST = 700_000, 80
_known: dict[str, list[dict[str, bytes]]] = {}


def encode_texts(texts: list[str], path: str) -> list[bytes]:
    """The ids of each text as little-endian unsigned 32-bit integers.

    Ids of chunks are kept in the worker between batches and tasks, in two generations.
    """
    known = _known.setdefault(path, [{}, {}])
    cut = [pre_tokens(text, path) for text in texts]
    new = set().union(*cut)
    if len(known[0]) + len(new) > REMEMBERED:
        known[:] = [{}, known[0]]
    late, old = known
    new = new.difference(late)
    again = new & old.keys()
    late.update(zip(again, map(old.__getitem__, again)))
    new -= again
    late.update(_ids_of(new, path))
    ids = [b"".join(map(late.__getitem__, chunks)) for chunks in cut]
    for chunk in new:
        if len(chunk) > LONGEST:
            del late[chunk]
    return ids


def token_counts(
    docs: DataFrame,
    path: str,
    limit: int,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Per row: ``doc_id, n_bytes, n_tokens, over_limit``."""

    def work(chunks: list[str]) -> list[bytes]:
        return [len(e).to_bytes(4, "little") for e in encoded(chunks, path)]

    def finish(ids, lengths, runs, times, n_bytes, values) -> pa.Table:
        each = np.frombuffer(b"".join(values), np.uint32).astype(np.int64)
        sums = np.concatenate([[0], np.cumsum(each[runs] * times)])
        ends = np.cumsum(lengths)
        tokens = sums[ends] - sums[ends - lengths]
        columns = [ids, pa.array(n_bytes), pa.array(tokens), pa.array(tokens > limit)]
        return pa.table(columns, ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return over_chunks(
        docs,
        id_column,
        text_column,
        lambda text: pre_tokens(text, path),
        work,
        finish,
        [("n_bytes", "long"), ("n_tokens", "long"), ("over_limit", "boolean")],
        counted=True,
    )
