"""BPE encoding and decoding with forced-boundary splitting.

A merge joins two neighbouring symbols into a vocabulary token, so two bytes
that stand next to each other inside no token can never end up in one token:
between them a cut is certain. Each pre-token is split at all its certain
cuts, the fragments are encoded independently, and their ids are joined. All
fragments of the words that a group of texts brings anew are merged together,
in array operations, one merge of each fragment at a time; words recur, so
their encodings are remembered.

The normaliser, pre-tokeniser and vocabulary are read from the tokenizer file
(word-level BPE with an end-of-word suffix, or plain byte-level BPE); special
tokens in a text are found first, as the file says. A map over rows.

Defined cases: a null or empty text has no tokens and decodes to the empty
text; repeated rows repeat; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

#: Remembered words per task before the memory starts anew.
REMEMBERED = 200_000
#: Characters of texts whose new words are learnt together; bytes of words in one set of arrays.
TEXTS, LEARNT_BYTES = 1 << 19, 1 << 17
#: Fragments with more symbols are merged by a queue.
LONG = 48
#: A rank behind all merges.
NO_MERGE = np.int32(2**31 - 1)
#: Unicode White_Space, written out (fixed values).
SPACE = "\t-\r \x85\xa0  -     　"


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in vocabulary files: printable
    bytes for themselves, the others for the characters from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, n = [], 0
    for b in range(256):
        letters.append(chr(b) if b in plain else chr(256 + n))
        n += b not in plain
    return letters


class ForcedBoundaryBpe:
    """Encoder and decoder of one tokenizer file."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.vocab: dict[str, int] = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ranks = {pair: rank for rank, pair in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token_of = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.letters = dict(enumerate(_byte_letters()))
        # Neighbours that occur inside some token; every other pair is a certain cut.
        # Pairs that end a word (their second symbol carries the suffix) are kept apart.
        self.joined: set[str] = set()
        self.joined_last: set[str] = set()
        for token in self.vocab:
            body = token.removesuffix(self.suffix) if self.suffix else token
            pairs_of = [body[i : i + 2] for i in range(len(body) - 1)]
            if self.suffix and token.endswith(self.suffix) and pairs_of:
                self.joined_last.add(pairs_of.pop())
            self.joined.update(pairs_of)
        if not self.suffix:
            self.joined_last = self.joined
        kinds = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        if kinds not in ([], ["NFC", "Replace", "Lowercase"]):
            raise ValueError(f"unknown normaliser {kinds}")
        self.normalises = bool(kinds)
        if spec.get("decoder") is not None:
            raise ValueError("a decoder is not supported")
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        if split["behavior"] != "Removed" or not split["invert"]:
            raise ValueError("unknown pre-tokeniser")
        self.find = regex.compile(split["pattern"]["Regex"].replace(r"[^\s", f"[^{SPACE}"), regex.V0).findall
        self.spaces = regex.compile(f"[{SPACE}]+")
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        # Characters whose class and case are the same in every Unicode version since 6.0.
        self.unsettled = regex.compile("[^\t\n\r -~\xa0-\u024f\u0391-\u03a1\u03a3-\u03ce\u0400-\u045f\u2010-\u2027\u20ac]").search
        self.path = path
        self.words: dict[str, tuple[bytes, bytes]] = {}
        self._tables()

    def _tables(self) -> None:
        """Merges, certain cuts and tokens as arrays. A symbol starts as a byte,
        or as 256 plus the byte where a word ends."""
        byte_of = {letter: b for b, letter in self.letters.items()}
        self.byte_of = {ord(letter): chr(b) for letter, b in byte_of.items()}
        both = [self.letters[b] for b in range(256)]
        both += [letter + self.suffix for letter in both]
        self.first_ids = np.array([self.vocab[letter] for letter in both], np.int32)
        self.inside = np.zeros((256, 512), bool)
        for pairs, shift in ((self.joined, 0), (self.joined_last, 256)):
            for pair in pairs:
                if pair[0] in byte_of and pair[1] in byte_of:
                    self.inside[byte_of[pair[0]], byte_of[pair[1]] + shift] = True
        self.span = max(self.vocab.values()) + 1
        pairs = [(self.vocab[a] * self.span + self.vocab[b], rank, self.vocab[a + b]) for (a, b), rank in self.ranks.items()]
        keys, ranks, merged = (np.array(x, np.int64) for x in zip(*pairs, strict=True)) if pairs else (np.empty(0, np.int64),) * 3
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = np.append(keys[order], -1), np.append(ranks[order], NO_MERGE).astype(np.int32)
        self.merged = np.zeros(int(ranks.max(initial=-1)) + 1, np.int32)
        self.merged[ranks] = merged
        first = self.first_ids.astype(np.int64)
        self.first_ranks = self._ranks_of(np.repeat(first[:256], 512), np.tile(first, 256)).reshape(256, 512)
        self.token_bytes = {i: t.encode() for i, t in self.token_of.items()}

    def _ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ranks of pairs of tokens."""
        keys = left.astype(np.int64) * self.span + right
        at = np.searchsorted(self.pair_keys[:-1], keys)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NO_MERGE)

    def normalise(self, text: str) -> str:
        if not self.normalises:
            return text
        if text.isascii():
            return text.lower()
        text = text if unicodedata.is_normalized("NFC", text) else unicodedata.normalize("NFC", text)
        # Character by character: no final sigma, no change that depends on neighbours.
        return text.replace("Σ", "σ").lower()

    def _merge(self, symbols: tuple[str, ...]) -> tuple[int, ...]:
        """Apply the merges to one fragment, lowest rank and leftmost first."""
        parts = list(symbols)
        if len(parts) > 48:
            return self._merge_long(parts)
        ranks = self.ranks
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = ranks.get((parts[i], parts[i + 1]))
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return tuple(self.vocab[p] for p in parts)

    def _merge_long(self, parts: list[str]) -> tuple[int, ...]:
        """As above with a queue of candidate pairs: long fragments stay linear."""
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        live: list[str | None] = list(parts)
        queue = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := self.ranks.get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(queue)
        while queue:
            _, i, a, b = heapq.heappop(queue)
            j = after[i]
            if live[i] != a or j >= n or live[j] != b:
                continue
            live[i], live[j] = a + b, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and (r := self.ranks.get((live[left], live[right]))) is not None:
                    heapq.heappush(queue, (r, left, live[left], live[right]))
        return tuple(self.vocab[p] for p in live if p is not None)

    def split(self, word: str) -> list[str]:
        """The fragments of a pre-token, cut at its certain boundaries. In a
        fragment each byte is one letter; the last one ends with a NUL."""
        letters = word if word.isascii() and word.isprintable() and " " not in word else word.encode().decode("latin-1").translate(self.letters)
        return self._cut(letters)

    def _cut(self, letters: str) -> list[str]:
        joined, out, start = self.joined, [], 0
        last = len(letters) - 2
        for i in range(last):
            if letters[i : i + 2] not in joined:
                out.append(letters[start : i + 1])
                start = i + 1
        if last >= 0 and letters[last:] not in self.joined_last:
            out.append(letters[start : last + 1])
            start = last + 1
        out.append(letters[start:] + "\0")
        return out

    def _merge_all(self, data: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The merges of all words in ``data`` (``last``: a word's last byte):
        for each byte the id of the token that starts there, or -1."""
        n = len(data)
        symbols = data.astype(np.int64)
        symbols[last] += 256
        ends = last.copy()
        ends[:-1] |= ~self.inside[data[:-1], symbols[1:]]
        out = np.full(n, -1, np.int32)
        ids = self.first_ids[symbols]
        ranks = np.full(n, NO_MERGE, np.int32)
        ranks[:-1] = np.where(ends[:-1], NO_MERGE, self.first_ranks[data[:-1], symbols[1:]])
        place = np.arange(n)
        stops = np.flatnonzero(ends) + 1
        sizes = np.diff(stops, prepend=0)
        if sizes.max() > LONG:
            for stop, size in zip(stops[sizes > LONG].tolist(), sizes[sizes > LONG].tolist(), strict=True):
                begin = stop - size
                long = self._merge(tuple(self.token_of[i] for i in ids[begin:stop].tolist()))
                out[begin : begin + len(long)] = long
            short = np.repeat(sizes <= LONG, sizes)
            ids, ranks, place, sizes = ids[short], ranks[short], place[short], sizes[sizes <= LONG]
        while len(ids):
            starts = np.cumsum(sizes) - sizes
            best = np.minimum.reduceat(ranks, starts)
            more = best < NO_MERGE
            if not more.all():  # fragments with no merge left
                live = np.repeat(more, sizes)
                out[place[~live]] = ids[~live]
                ids, ranks, place, sizes, best = ids[live], ranks[live], place[live], sizes[more], best[more]
                if not len(ids):
                    break
                starts = np.cumsum(sizes) - sizes
            # The leftmost of the lowest rank in each fragment.
            fragment = np.repeat(np.arange(len(sizes)), sizes)
            hit = np.flatnonzero(ranks == best[fragment])
            owner = fragment[hit]
            hit = hit[np.concatenate([[True], owner[1:] != owner[:-1]])]
            ids[hit] = self.merged[best]
            stays = np.ones(len(ids), bool)
            stays[hit + 1] = False
            ids, ranks, place = ids[stays], ranks[stays], place[stays]
            sizes = sizes - 1
            at = hit - np.arange(len(hit))  # one symbol of each fragment before has gone
            starts = np.cumsum(sizes) - sizes
            right = at + 1 < starts + sizes
            ranks[at] = NO_MERGE
            ranks[at[right]] = self._ranks_of(ids[at[right]], ids[at[right] + 1])
            before = at[at > starts]
            ranks[before - 1] = self._ranks_of(ids[before - 1], ids[before])
        return out

    def _learn(self, words: list[str]) -> None:
        """Remember the ids of pre-tokens, and those ids decoded."""
        held, size = [], 0
        for word in words:
            raw = word[1:].translate(self.byte_of).encode("latin-1") if word[0] == "\0" else word.encode()
            held.append((word, raw))
            size += len(raw)
            if size >= LEARNT_BYTES:
                self._learn_together(held)
                held, size = [], 0
        if held:
            self._learn_together(held)

    def _learn_together(self, held: list[tuple[str, bytes]]) -> None:
        data = np.frombuffer(b"".join([raw for _, raw in held]), np.uint8)
        stops = np.cumsum([len(raw) for _, raw in held])
        last = np.zeros(len(data), bool)
        last[stops - 1] = True
        out = self._merge_all(data, last)
        tokens = out >= 0
        ids = out[tokens]
        cuts = np.cumsum(tokens)[stops - 1].tolist()
        raw, texts = ids.astype("<u4").tobytes(), [self.token_bytes[i] for i in ids.tolist()]
        begin = 0
        for (word, _), stop in zip(held, cuts, strict=True):
            self.words[word] = raw[4 * begin : 4 * stop], b" ".join(texts[begin:stop])
            begin = stop

    def decode(self, ids) -> str:
        """The tokens of the ids joined by blanks (the file names no decoder);
        special tokens are kept, unknown ids are skipped."""
        return " ".join(self.token_of[i] for i in ids if i in self.token_of)

    def _pretokens(self, text: str) -> list[str]:
        """Words by the file's pattern. Texts with characters that Unicode
        versions class differently are split by the file's own pipeline; its
        words, already in byte letters, are marked with a leading NUL."""
        if self.unsettled(text):
            own = _own(self.path)
            normal = own.normalizer.normalize_str(text) if own.normalizer else text
            return ["\0" + w for w, _ in own.pre_tokenizer.pre_tokenize_str(normal)]
        return self.find(self.normalise(text))

    def _found(self, text: str) -> list[list[str] | str]:
        """The pre-tokens of a text as lists, special tokens between them."""
        if self.specials is None or not self.specials.search(text):
            return [self._pretokens(text)]
        return [part if i % 2 else self._pretokens(part) for i, part in enumerate(self.specials.split(text)) if part]

    def _joined_up(self, found: list[list[str] | str]) -> tuple[bytes, bytes]:
        ids, texts = [], []
        for part in found:
            if isinstance(part, str):
                ids.append(np.array([self.special[part]], "<u4").tobytes())
                texts.append(part.encode())
            else:
                known = [self.words[w] for w in part]
                ids += [k[0] for k in known]
                texts += [k[1] for k in known]
        return b"".join(ids), b" ".join(texts)

    def encode_and_decode_all(self, texts: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """For each text (ids as little-endian unsigned 32-bit integers, decoded
        text in UTF-8). New words of some texts are learnt together."""
        held, size = [], 0
        for i, text in enumerate(texts):
            held.append(self._found(text))
            size += len(text)
            if size >= TEXTS or i == len(texts) - 1:
                seen = {w for found in held for part in found if not isinstance(part, str) for w in part}
                new = seen.difference(self.words)
                if len(self.words) + len(new) > REMEMBERED:
                    self.words.clear()
                    new = seen
                self._learn(list(new))
                yield from map(self._joined_up, held)
                held, size = [], 0

    def encode_and_decode(self, text: str) -> tuple[bytes, bytes]:
        """(ids as little-endian unsigned 32-bit integers, decoded text in UTF-8)."""
        return next(self.encode_and_decode_all([text]))

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encode_and_decode(text)[0], "<u4")


@lru_cache(maxsize=2)
def _own(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=2)
def bpe(path: str) -> ForcedBoundaryBpe:
    return ForcedBoundaryBpe(path)


def bpe_round_trip(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every row's whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = bpe(tokenizer)
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for ids, decoded in codec.encode_and_decode_all(batch.column(1).to_pylist()):
                counts.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(decoded).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())],
                [id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    picked = docs.select(id_col, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__text"))
    kind = picked.schema[id_col].dataType.simpleString()
    return map_arrow(picked, run, f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<bigint>) of every row's whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = bpe(tokenizer)
        for batch in batches:
            encoded = codec.encode_and_decode_all(batch.column(1).to_pylist())
            ids = pa.array([np.frombuffer(ids, "<u4").astype(np.int64) for ids, _ in encoded], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], [id_col, "ids"])

    picked = docs.select(id_col, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("__text"))
    return map_arrow(picked, run, f"`{id_col}` {picked.schema[id_col].dataType.simpleString()}, ids array<bigint>")
