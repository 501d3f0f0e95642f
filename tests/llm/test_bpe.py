import hashlib
import random

import numpy as np
from llm_texts import texts_with_everything
from tokenizers import Tokenizer

from ledgerlens.llm import bpe as bpe_module
from ledgerlens.llm.bpe import ForcedBoundaryBpe, bpe_round_trip, encode_documents


def odd_texts(n, seed=3):
    rng = random.Random(seed)
    pool = [chr(c) for c in range(1, 0x250)] + [chr(rng.randint(0x250, 0xD7FF)) for _ in range(800)] + [chr(rng.randint(0x10000, 0x1FFFF)) for _ in range(200)]
    pool += ["<|endoftext|>", "<|startoftext|>", "'s", "'LL", "İ", "Σ", "ß", "ﬁ", "é", " ", "\n", "\x1c", "\x85", "</w>", "x</w>y"] * 8
    return ["".join(rng.choices(pool, k=rng.randint(0, 40))) for _ in range(n)] + ["", "a" * 5000, "ab" * 2000, "x</w>abc x</w>", "9" * 50]


def test_encoding_equals_the_tokenizers_library(word_bpe):
    own, library = ForcedBoundaryBpe(word_bpe), Tokenizer.from_file(word_bpe)
    texts = odd_texts(1500) + [t or "" for _, t in texts_with_everything()]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        ids, decoded = own.encode_and_decode(text)
        assert np.frombuffer(ids, "<u4").tolist() == want.ids, text
        assert decoded.decode() == library.decode(want.ids, skip_special_tokens=False)


def test_cuts_are_certain(word_bpe):
    own = ForcedBoundaryBpe(word_bpe)
    assert own.split("zqxj") != ["zqxj\0"]  # some byte pairs occur in no token
    for word in ["hello", "zqxj", "größe", "aaaa", "xzxzxq", "你好"]:
        fragments = own.split(word)
        assert "".join(fragments)[:-1] == word.encode().decode("latin-1").translate(own.letters)
        whole = [word.encode().decode("latin-1").translate(own.letters)]
        symbols = [*whole[0][:-1], whole[0][-1] + own.suffix]
        assert np.frombuffer(own.encode(word), "<u4").tolist() == list(own._merge(tuple(symbols)))


def test_long_fragments_by_queue_equal_the_plain_merges(word_bpe):
    own = ForcedBoundaryBpe(word_bpe)
    rng = random.Random(1)
    for _ in range(50):
        parts = rng.choices(list("abcdehinorst"), k=rng.randint(2, 47))
        parts[-1] += own.suffix
        assert own._merge_long(list(parts)) == own._merge(tuple(parts))


def test_new_words_are_merged_together(word_bpe, monkeypatch):
    rng = random.Random(5)
    letters = "abcdefghilmnoprstuéß"
    texts = [" ".join("".join(rng.choices(letters, k=rng.randint(1, 12))) for _ in range(200)) for _ in range(30)]
    texts += ["q" * 300 + " <|endoftext|>x " + "ab" * 90, "<|endoftext|>", ""]
    own, library = ForcedBoundaryBpe(word_bpe), Tokenizer.from_file(word_bpe)
    alone = []
    merge = own._merge
    monkeypatch.setattr(own, "_merge", lambda symbols: alone.append(len(symbols)) or merge(symbols))
    monkeypatch.setattr(bpe_module, "REMEMBERED", 500)
    monkeypatch.setattr(bpe_module, "TEXTS", 3000)
    monkeypatch.setattr(bpe_module, "LEARNT_BYTES", 700)
    got = [np.frombuffer(ids, "<u4").tolist() for ids, _ in own.encode_and_decode_all(texts)]
    assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert min(alone, default=99) > 48  # only long fragments are merged one by one


def test_query_rows(docs, word_bpe):
    library = Tokenizer.from_file(word_bpe)
    rows = texts_with_everything()
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((str(i), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    got = bpe_round_trip(docs(rows), word_bpe).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(want)
    assert bpe_round_trip(docs([]), word_bpe).collect() == []
    ids = {r.doc_id: r.ids for r in encode_documents(docs([(1, "Hello you"), (2, None)]), word_bpe).collect()}
    assert ids == {1: library.encode("Hello you", add_special_tokens=False).ids, 2: []}
