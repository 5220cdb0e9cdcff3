"""op2 and op3 against the public libraries, on real and odd texts."""

import hashlib
import random

import public_tokenizers
import pytest

from layerflow.llm import piece_codec, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
BITS = [
    " ", "  ", "\n", "\t", "a", "e", "the", "ing", ".", ",", "!", "1", "23", "é", "ß", "😀", "日", "▁", "<s>", "<0x0A>", "²", "-", "_", "(",
    "́", "\x00", "�", "A", "Zq", "'s", "\r", "　", "ﬁ", "http://", "::", ");", "<|endoftext|>", "<|endof", "text|>", "\x85", "İ",
]


def _texts(n, most, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(BITS) for _ in range(rnd.randint(0, most))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=MODEL)


def test_pieces_equal_the_library(library):
    own = piece_codec.PieceCodec(MODEL, memo_entries=300)  # small memory: forgets on the way
    for text in [*_texts(1500, 50), "x" * 3000, " " * 500, "ab" * 900 + "!" * 300]:
        ids = library.encode(text, add_bos=True, add_eos=True)
        assert own.encode(text) == ids
        assert own.decode(ids).decode() == library.decode(ids)


def test_longest_matches():
    """The automaton's matches from any place are the longest tokens there."""
    own = piece_codec.PieceCodec(MODEL)
    for text in _texts(400, 40, seed=8):
        s = "▁" + text.replace(" ", "▁")
        for at in range(len(s)):
            known = {}
            own.longest(s, at, known)
            for place, i in known.items():
                want = max((k for k in range(1, min(24, len(s) - place) + 1) if s[place:place + k] in own.ids), default=None)
                assert i == (own.ids[s[place:place + want]] if want else -1)


def test_backtracking_leaves_the_longest_match(library):
    """A longest first token is not always right; the search must come back from it."""
    own = piece_codec.PieceCodec(MODEL)
    rnd = random.Random(3)
    greedy_wrong = 0
    for _ in range(3000):
        s = "▁" + "".join(rnd.choice("aeinorst") for _ in range(12))
        found = own.tokens(s)
        assert found == [own.ids[p] for p in own.remerge(s)]
        at, greedy = 0, []
        while at < len(s):
            n = max(k for k in range(1, len(s) + 1) if s[at:at + k] in own.ids)
            greedy.append(own.ids[s[at:at + n]])
            at += n
        greedy_wrong += greedy != found
    assert greedy_wrong > 100


def test_codec_on_odd_rows(odd, odd_rows, none, library):
    got = piece_codec.codec_digest(odd, MODEL).collect()
    want = []
    for i, text, *_ in odd_rows:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        want.append((i, len(ids), hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest(),
                     hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert piece_codec.codec_digest(none, MODEL).count() == 0


def test_encoded_documents_decode_again(odd, library):
    back = piece_codec.decode_documents(piece_codec.encode_documents(odd, MODEL), MODEL).collect()
    assert len(back) == odd.count() and "one two three" in {r.text for r in back}


def test_counts_equal_the_library(odd, odd_rows, none):
    own = token_counts.TokenCounter(WORDS)
    plain = lambda t: len(own.tokenizer.encode(t, add_special_tokens=False))
    got = sorted(map(repr, map(tuple, token_counts.token_counts(odd, WORDS, limit=10).collect())))
    want = [(i, len((t or "").encode()), plain(t or ""), plain(t or "") > 10) for i, t, *_ in odd_rows]
    assert got == sorted(map(repr, want))
    assert token_counts.token_counts(none, WORDS).count() == 0
    assert [own.count(t.encode()) for t in _texts(800, 40)] == [plain(t) for t in _texts(800, 40)]


def test_chunks_are_resynchronised_and_widened():
    own = token_counts.TokenCounter(WORDS, chunk=120, overlap=8)
    texts = [*_texts(300, 400, 5), "word " * 300, "x" * 2000 + " y", "ab,cd" * 400, "é" * 900]
    assert [own.count(t.encode()) for t in texts] == [len(own.tokenizer.encode(t, add_special_tokens=False)) for t in texts]
    assert own.widened > 0


def test_remembered_ids_are_one_object_each():
    """The codec's memories hold tuples of ids; an id is the same object in all of them."""
    own = piece_codec.PieceCodec(public_tokenizers.path("piece_bpe_32k.model"))
    own.encode("several different words, several differing words; different again, 漢字 x漢")
    ids = [i for memory in (own.words, own.memo) for value in memory.young.values() for i in value if i not in own.byte_ids.values()]
    assert len(ids) > 8
    assert len({id(i) for i in ids}) == len(set(ids))
