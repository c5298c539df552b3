"""Splitting text as byte-level BPE tokenizers do, before their merges."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The letters and numbers among the characters that SAFE allows.
_L, _N = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾"
#: Texts of only these characters are split by FAST; any other is split by the library itself.
_SAFE = r"\t-\r\x20-\x7e\u00a0-ɏ‐-‧‰-⁞₠-₿"
UNSAFE = re.compile(f"[^{_SAFE}]")
FAST = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^\s{_L}{_N}]+|\s+(?!\S)|\s+")


def byte_characters() -> dict[int, str]:
    """The character that byte-level vocabularies write for each byte: printable ones stand for themselves, the others
    follow from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


def splitter(tokenizer_path: str) -> Callable[[str], list[str]]:
    """A function from text to its pieces. The library's own splitter is loaded for the first text of unusual characters:
    it takes some 30 MB in each worker."""

    @cache
    def own():
        from tokenizers import Tokenizer

        return Tokenizer.from_file(tokenizer_path).pre_tokenizer

    def split(text: str) -> list[str]:
        if UNSAFE.search(text):
            return [text[a:b] for _, (a, b) in own().pre_tokenize_str(text)]
        return FAST.findall(text)

    return split


#: White space among the characters that SAFE allows, and a space. Runs of it are pieces that cuts at spaces would part.
RUNS = [c + " " for c in " \t\n\v\f\r\xa0"]


def chunkable(text: str) -> bool:
    """Whether text.split(' ') cuts only where pieces begin, so that the chunks, each but the first with its space in
    front, are split on their own: so it is for usual characters where no space follows other white space."""
    return not any(r in text for r in RUNS) and not UNSAFE.search(text)


def keep_half(memo: dict) -> None:
    """Drops the later half of a memo; what was met first is mostly what is frequent."""
    kept = list(islice(memo.items(), len(memo) // 2))
    memo.clear()
    memo.update(kept)


@dataclass
class Split:
    """Texts as numbers of chunks, chunks as numbers of pieces; chunks and pieces are distinct."""

    pieces: pa.StringArray
    numbers: np.ndarray  # pieces of all chunks
    ends: np.ndarray  # of each chunk in numbers, a zero first
    chunks: np.ndarray  # chunks of all texts
    bounds: np.ndarray  # of each text in chunks, a zero first

    def counts(self) -> np.ndarray:
        """How often each piece occurs in the texts."""
        each = np.bincount(self.chunks, minlength=len(self.ends) - 1)
        return np.bincount(self.numbers, np.repeat(each, np.diff(self.ends)), len(self.pieces)).astype(np.int64)

    def fill(self, of_piece: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """What the pieces stand for in place of them: all values, and where each text ends in them, a zero first."""
        of_chunk = pa.ListArray.from_arrays(pa.array(self.ends, pa.int32()), pa.array(self.numbers))
        sizes = np.diff(of_piece.offsets.to_numpy())
        inner = of_piece.take(of_chunk.values)
        upto = np.concatenate([[0], np.cumsum(sizes[self.numbers])])
        of_chunk = pa.ListArray.from_arrays(pa.array(upto[self.ends], pa.int32()), inner.flatten())
        upto = np.concatenate([[0], np.cumsum(np.diff(upto[self.ends])[self.chunks])])
        return of_chunk.take(pa.array(self.chunks)).flatten().to_numpy(), upto[self.bounds]


def usual(texts: pa.StringArray) -> pa.BooleanArray:
    """chunkable() of each text."""
    safe, runs = _SAFE.replace(r"\u00a0", "\u00a0"), "|".join(RUNS)
    return pc.invert(pc.match_substring_regex(texts, f"[^{safe}]|{runs}"))


def split_usual(texts: pa.StringArray) -> Split:
    """Splits chunkable texts. Only chunks other than a word, with a comma or full stop or without, become Python objects."""
    lists = pc.split_pattern(texts, " ")
    bounds, flat = lists.offsets.to_numpy().astype(np.int64), lists.flatten()
    coded = flat.dictionary_encode()
    first = flat.take(pa.array(bounds[:-1])).dictionary_encode()
    table, chunks = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    chunks[bounds[:-1]] = len(table) + first.indices.to_numpy()  # they have no space in front
    word = pc.match_substring_regex(table, rf"\A[{_L}]+\z").to_numpy(zero_copy_only=False)
    ended = pc.match_substring_regex(table, rf"\A[{_L}]+[,.]\z").to_numpy(zero_copy_only=False)
    other = np.flatnonzero(~word & ~ended)
    cut = [FAST.findall(" " + c) for c in table.take(pa.array(other)).to_pylist()] + [FAST.findall(c) for c in first.dictionary.to_pylist()]
    sizes = np.concatenate([np.ones(len(table), np.int64), np.zeros(len(first.dictionary), np.int64)])
    sizes[np.flatnonzero(ended)] = 2
    rest = np.concatenate([other, np.arange(len(table), len(sizes))])
    sizes[rest] = own = np.array(list(map(len, cut)), np.int64)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    marked = table.filter(pa.array(ended))
    spaced = pc.binary_join_element_wise("", pa.concat_arrays([table.filter(pa.array(word)), pc.utf8_slice_codeunits(marked, 0, -1)]), " ")
    every = pa.concat_arrays([spaced, pc.utf8_slice_codeunits(marked, -1), pa.array([p for c in cut for p in c], pa.string())]).dictionary_encode()
    at = np.concatenate([ends[:-1][: len(table)][word], ends[:-1][: len(table)][ended], ends[:-1][: len(table)][ended] + 1, np.repeat(ends[:-1][rest] - np.cumsum(own) + own, own) + np.arange(own.sum())])
    numbers = np.empty(len(at), np.int64)
    numbers[at] = every.indices.to_numpy()
    return Split(every.dictionary, numbers, ends, chunks, bounds)


def split_listed(cut: list[list[str]]) -> Split:
    """The pieces of texts that were split already, each as a chunk."""
    coded = pa.array([p for c in cut for p in c], pa.string()).dictionary_encode()
    ends = np.concatenate([[0], np.cumsum(np.array(list(map(len, cut)), np.int64))])
    return Split(coded.dictionary, coded.indices.to_numpy().astype(np.int64), ends, np.arange(len(cut)), np.arange(len(cut) + 1))


def around(text: str, special: list[str]) -> list[str]:
    """text, cut around the special strings in it; the leftmost first, of those the longest."""
    out = []
    while text:
        at, _, s = min(((text.find(s), -len(s), s) for s in special if s in text), default=(-1, 0, ""))
        if at < 0:
            out.append(text)
            break
        out += ([text[:at]] if at else []) + [s]
        text = text[at + len(s) :]
    return out


def encode(texts: pa.StringArray, special: list[str], split: Callable[[str], list[str]], merged: Callable[[pa.StringArray], pa.ListArray], kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, none of them null, and where each text ends in them, a zero first.

    merged gives the ids of each of some distinct pieces, special strings among them; split cuts unusual texts.
    """
    plain = usual(texts)
    for s in special:
        plain = pc.and_not(plain, pc.match_substring(texts, s))
    plain = plain.to_numpy(zero_copy_only=False)
    groups = []
    if plain.any():
        groups.append((np.flatnonzero(plain), split_usual(texts.filter(pa.array(plain)))))
    if not plain.all():
        cut = [[p for x in around(t, special) for p in ([x] if x in special else split(x))] for t in texts.filter(pa.array(~plain)).to_pylist()]
        groups.append((np.flatnonzero(~plain), split_listed(cut)))
    done = [(at, *part.fill(merged(part.pieces))) for at, part in groups]
    if len(done) == 1:
        return done[0][1:]
    each: list[np.ndarray] = [np.zeros(0, kind)] * len(texts)
    for at, ids, ends in done:
        for i, a, z in zip(at.tolist(), ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            each[i] = ids[a:z]
    return np.concatenate([np.zeros(0, kind), *each]), np.concatenate([[0], np.cumsum(np.array(list(map(len, each)), np.int64))])
