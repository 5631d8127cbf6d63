"""Token ids by remembered pieces, and the retrieval of packing, against plain versions."""

import random

import numpy as np
import pandas as pd

from ripplelake.llm import packing, tokens

SPACES = [*" \n\t\r\x0b\x0c", *map(chr, (0x85, 0xA0, 0x1680, 0x2003, 0x2028, 0x205F, 0x3000))]


def texts_of(n, seed):
    made = random.Random(seed)
    letters = [*"abcdeinorst'.,!X09\x00\x1c", "é", "ß", "中", "😀", "​", "Â", "<|endoftext|>"]
    words = ["".join(made.choices(letters, k=made.randrange(1, 12))) for _ in range(900)] + ["w" * 16, "w" * 15, "w" * 17, "ab" * 40, "\x00"]
    return ["".join(made.choice(words) + "".join(made.choices(SPACES, [9, *[1] * 12], k=made.choice([1, 1, 1, 0, 3]))) for _ in range(made.randrange(60)))
            for _ in range(n)]


def library(encoder, texts):
    return [e.ids for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_ids_over_generations(monkeypatch):
    """Tables that grow and are given up while the same pieces come again; rows of pieces of any length."""
    monkeypatch.setattr(tokens, "REMEMBER", 300)
    monkeypatch.setattr(tokens, "TOGETHER", 7)
    encoder = tokens.Encoder(tokens.vocabulary())
    encoder.known = tokens.Known(4)
    for seed in range(12):
        texts = texts_of(40, seed % 5) + ["", " ", "a"]
        expected = library(encoder, texts)
        assert [x.tolist() for x in encoder.ids(texts)] == expected
        assert encoder.count(texts) == [len(x) for x in expected]
        for text, ids in zip(texts, expected):
            starts, before = encoder.offsets(text)
            assert before[-1] == len(ids) and len(before) == len(starts) + 1
            assert before.tolist() == [len(x) for x in library(encoder, [text[:at] for at in starts.tolist()])] + [len(ids)]
    assert encoder.ids([]) == [] and encoder.count([]) == []


def test_the_library_is_asked_for_many_pieces_at_once():
    encoder, asked = tokens.Encoder(tokens.vocabulary()), []

    class Counting:
        def __init__(self, tokenizer):
            self.tokenizer = tokenizer

        def __getattr__(self, name):
            return getattr(self.tokenizer, name)

        def encode_batch_fast(self, texts, **more):
            asked.extend(texts)
            return self.tokenizer.encode_batch_fast(texts, **more)

    encoder.tokenizer = Counting(encoder.tokenizer)
    made = random.Random(4)
    text = " ".join("".join(made.choices("abdeinorst", k=8)) for _ in range(5000))
    assert encoder.count([text]) == [len(encoder.tokenizer.tokenizer.encode(text, add_special_tokens=False).ids)]
    assert len(asked) < 50


def units_of(n, seed):
    made = np.random.default_rng(seed)
    units = [made.zipf(1.3, made.integers(1, 60)).clip(1, 500).astype("<u4") for _ in range(n)]
    return units + [units[k].copy() for k in made.integers(0, n, n // 4)]  # ties


def test_terms_of_units_at_once():
    units = units_of(700, 1)
    terms, counts = np.unique(np.concatenate([np.unique(u) for u in units]), return_counts=True)
    found = pd.concat(packing._frequencies(iter([pd.DataFrame({"ids": [u.tobytes() for u in units]})])))
    assert found["term"].tolist() == terms.tolist() and found["n"].tolist() == counts.tolist()
    args = len(units), sum(map(len, units)) / len(units), terms.astype(np.int64), counts
    weights = packing.Weights(*args)
    owner, found, impacts = weights.of(units)
    expected = []
    for k, unit in enumerate(units):
        its, tf = np.unique(unit, return_counts=True)
        tf = tf.astype(np.float32)
        scale = packing.K1 * (1 - packing.B + packing.B * len(unit) / weights.mean)
        expected.append((np.full(len(its), k), its, weights.idf[its] * tf * (packing.K1 + 1) / (tf + scale)))
    for got, plain in zip((owner, found, impacts), map(np.concatenate, zip(*expected))):
        assert got.tolist() == plain.tolist()

    class Sent:
        value = args

    routed = pd.concat(packing._route(Sent)(iter([pd.DataFrame({"ids": [u.tobytes() for u in units]})])))
    best = [its[np.argsort(-impact, kind="stable")[:2]] for _, its, impact in expected]
    assert routed["first"].tolist() == [b[0] for b in best] and routed["second"].tolist() == [b[-1] for b in best]


def test_common_terms_are_scored_like_others(monkeypatch):
    units = units_of(300, 2)
    terms, counts = np.unique(np.concatenate([np.unique(u) for u in units]), return_counts=True)

    def packed():
        packer = packing.Packer(packing.Weights(len(units), 25.0, terms.astype(np.int64), counts), 64, 0)
        packer.shard([(k, 0, u, len(u)) for k, u in enumerate(units)])
        return packer.rows

    monkeypatch.setattr(packing, "COMMON", 1)  # none is
    plain = packed()
    monkeypatch.setattr(packing, "COMMON", 1000)
    assert packed() == plain and len(plain) > 100


def test_words_are_asked_of_the_model_once_whatever_follows(monkeypatch):
    encoder, split = tokens.Encoder(tokens.vocabulary()), []
    rows = encoder._ask_rows
    monkeypatch.setattr(encoder, "_ask_rows", lambda pieces: split.extend(pieces) or rows(pieces))
    made = random.Random(5)
    words = ["".join(made.choices("abdeiéß", k=7)) for _ in range(400)]
    text = " ".join(w + mark for mark in ("", ".", ",", "!", "%%%", "-x") for w in words)
    assert encoder.ids([" " + text])[0].tolist() == library(encoder, [" " + text])[0]
    assert encoder.known.pieces + len(encoder.known.long) <= 400 + 6
    assert len(split) <= 5  # the marks


def test_letters_and_what_ends_them():
    """Any character between letters, before and after marks; added tokens in words; contractions."""
    encoder = tokens.Encoder(tokens.vocabulary())
    chars = [*map(chr, range(0x900)), "中", " ", "ꙮ", "ﬁ", "😀", "\U00010400"]
    texts = [f"b{c}b. {c}. a{c}, {c}{c}!a {c}'s b{c}'s. x{c}-{c}%" for c in chars]
    texts += ["a<|endoftext|>.b", "a.<|endoftext|>b", "don't. we'll, it's's 's. a's.b", "a<|endoftext", "|>a.", "é.", "a.", " .", ".a", "aé.éa!"]
    assert [x.tolist() for x in encoder.ids(texts)] == library(encoder, texts)
    assert [x.tolist() for t in texts for x in encoder.ids([t])] == library(encoder, texts)


def test_added_tokens_and_other_splittings_are_not_cut(tmp_path):
    from tokenizers import AddedToken, Tokenizer, pre_tokenizers

    texts = texts_of(60, 9) + ["xab.cy ab.c, ab.c", "abcab. abc", "a9.b", "b.", "ab,ab."]
    for k, change in enumerate([
        lambda t: t.add_tokens([AddedToken("ab.c")]),
        lambda t: t.add_tokens([AddedToken("ab", normalized=False)]),
        lambda t: t.add_tokens([AddedToken("ab", single_word=True)]),
        lambda t: t.add_tokens([AddedToken("ab,", rstrip=True)]),
        lambda t: setattr(t, "pre_tokenizer", pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(False, use_regex=False)])),
    ]):
        tokenizer = Tokenizer.from_file(tokens.vocabulary())
        change(tokenizer)
        tokenizer.save(path := str(tmp_path / f"{k}.json"))
        encoder = tokens.Encoder(path)
        assert [x.tolist() for x in encoder.ids(texts)] == library(encoder, texts), k


def test_ids_of_two_bytes_are_packed_like_ids_of_four():
    assert tokens.id_type(tokens.vocabulary()) == "<u2"
    units = units_of(700, 3)
    small = [u.astype("<u2") for u in units]
    for got, plain in zip(packing._terms(small), packing._terms(units)):
        assert got.tolist() == plain.tolist()
    found = pd.concat(packing._frequencies(iter([pd.DataFrame({"ids": [u.tobytes() for u in small]})]), "<u2"))
    terms, counts = np.unique(np.concatenate([np.unique(u) for u in units]), return_counts=True)
    assert found["term"].tolist() == terms.tolist() and found["n"].tolist() == counts.tolist()
    many = [np.array([k % 7, 65_535], "<u2") for k in range(70_000)]  # more than two bytes count
    owner, terms, counts = packing._terms(many)
    assert owner.tolist() == np.repeat(np.arange(70_000), 2).tolist() and terms.tolist() == np.concatenate(many).tolist() and set(counts) == {1}
