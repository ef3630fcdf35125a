"""Token ids of whole texts with a byte-level vocabulary, each distinct word once per block.

The vocabulary's splitting rule never joins a word with what follows it, and takes at
most one space, the last of a run, into the word after it.  So a text's ids are those of
its white-space runs and words, one after another.  Texts with other white space than
ASCII or with a special token's string don't follow from their words and are encoded whole.
"""

from __future__ import annotations

import functools
import json
import os
import re

import numpy as np
import pyarrow as pa

from tollgate.llm.words import group_order, words

ODD = re.compile("[\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: The byte-level splitting rule, a fixed value of the format.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CHUNK = 20_000


@functools.lru_cache(maxsize=4)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@functools.lru_cache(maxsize=4)
def fast(path: str):
    """The same vocabulary for tiktoken, which gives the same ids sooner: ids ascend with the ranks of merges."""
    import tiktoken

    codes = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of = {chr(b): b for b in codes} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in codes)}
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    ranks = {bytes(of[c] for c in token): i for token, i in vocabulary.items()}
    return tiktoken.Encoding("units", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encode(path: str, text: str) -> np.ndarray:
    return np.array(tokenizer(path).encode(text, add_special_tokens=False).ids, np.uint32)


@functools.lru_cache(maxsize=4)
def _specials(path: str) -> tuple[str, ...]:
    return tuple(x.content for x in tokenizer(path).get_added_tokens_decoder().values())


def _units(path: str, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of strings without line ends, and where each begins; a line end is always one id of its own."""
    line_end = int(encode(path, "\n")[0])
    parts, lengths = [], []
    for i in range(0, len(units), CHUNK):
        part = units[i : i + CHUNK]
        ids = np.array(fast(path).encode_ordinary("\n".join(part)), np.uint32)
        ends = np.flatnonzero(ids == line_end)
        lengths.append(np.diff(np.concatenate(([-1], ends, [len(ids)]))) - 1)
        parts.append(ids[ids != line_end])
        assert len(ends) == len(part) - 1
    none = np.zeros(0, np.int64)
    return np.concatenate(parts) if parts else none.astype(np.uint32), np.concatenate(lengths) if lengths else none


def ids_of(texts: pa.Array, path: str, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, ``end`` after each, and the offsets of the texts in them."""
    w = words(texts)
    data, n, docs = w.data, len(w.starts), len(w.offsets) - 1
    before = np.zeros(n, np.int64)  # where the white space before each word begins
    before[1:] = w.ends[:-1]
    heads = w.first[:-1][w.counts > 0]
    before[heads] = w.offsets[:-1][w.counts > 0]
    gap = w.starts - before
    spaced = (gap > 0) & (data[w.starts - 1] == 0x20) if n else np.zeros(0, bool)
    order, head = group_order(w.hashes() ^ spaced.astype(np.uint64) * np.uint64(0x5BD1E9955BD1E995))
    unit = np.empty(n, np.int64)
    unit[order] = np.cumsum(head) - 1
    some = order[head]
    blob = data.tobytes()
    odd = _whole(path, blob)
    units = [blob[s - p : e].decode() for s, e, p in zip(w.starts[some].tolist(), w.ends[some].tolist(), spaced[some].tolist())]
    pool, lengths = _units(path, [("!" if odd(x) else x) for x in units] if odd else units)
    pools, sizes, known = [pool], [lengths], {}

    def item(ids: np.ndarray) -> int:
        pools.append(ids)
        sizes.append(np.array([len(ids)]))
        return len(lengths) + len(sizes) - 2

    def run(key: tuple) -> int:
        if key not in known:
            known[key] = item(np.concatenate([encode(path, x.decode()) if isinstance(x, bytes) else np.array([x], np.uint32) for x in key] or [np.zeros(0, np.uint32)]).astype(np.uint32))
        return known[key]

    items = np.empty(2 * n + docs, np.int64)
    shift = w.texts()
    items[2 * np.arange(n) + shift] = run(())
    items[2 * np.arange(n) + shift + 1] = unit
    for i in np.flatnonzero(gap != spaced).tolist():
        space = blob[before[i] : w.starts[i] - spaced[i]]
        items[2 * i + shift[i]] = run((space,) if spaced[i] else tuple(x for x in (space[:-1], space[-1:]) if x))
    tails = 2 * w.first[1:] + np.arange(docs)
    items[tails] = run((end,))
    last = w.offsets[:-1].copy()  # where the white space after the last word begins
    last[w.counts > 0] = w.ends[w.first[1:][w.counts > 0] - 1]
    for d in np.flatnonzero(last < w.offsets[1:]).tolist():
        items[tails[d]] = run((blob[last[d] : w.offsets[d + 1]], end))
    for d in range(docs) if odd else ():
        text = blob[w.offsets[d] : w.offsets[d + 1]].decode()
        if odd(text):
            items[2 * w.first[d] + d : tails[d]] = run(())
            items[tails[d]] = item(np.concatenate((encode(path, text), np.array([end], np.uint32))))
    length = np.concatenate(sizes)
    begin = np.cumsum(length) - length
    taken = length[items]
    stop = np.cumsum(taken)
    ids = np.concatenate(pools)[np.repeat(begin[items] - (stop - taken), taken) + np.arange(stop[-1] if len(stop) else 0)]
    return ids.astype(np.uint32), np.concatenate(([0], stop[tails])).astype(np.int64)


def _whole(path: str, blob: bytes):
    """A test for texts that must be encoded whole, or None if there is none."""
    specials = _specials(path)
    odd = lambda text: bool(ODD.search(text)) or any(x in text for x in specials)
    return odd if odd(blob.decode()) else None


