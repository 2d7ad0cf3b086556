import hashlib

import public_tokenizers as P
import tiktoken

from pitboss.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")
ODD = [None, "", " ", "\n", "  two  spaces ", "héllo wörld 😀👩‍👩‍👧 \n\n  x", "<|endoftext|>", "don't I'VE\t\t\n a" * 20,
       "a" * 3000, "😀" * 200, "​　 日本語", "\x00\x01", "a \x1c b\x85 c\xa0 d", "x" * 50 + " " * 40 + "1234 5,6"]


def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def test_same_ids_as_the_library_and_exact_round_trip(make_docs, small):
    rows = [(i, t) for i, (_, t) in enumerate([*small, *[(0, t) for t in ODD], (0, small[0][1])])]
    out = {r["doc_id"]: r for r in bpe.round_trip(make_docs(rows), PATH, P.PATTERN).collect()}
    enc = library()
    for i, text in rows:
        ids = enc.encode_ordinary(text or "")
        assert out[i]["n_tokens"] == len(ids)
        assert out[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert out[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
        assert out[i]["round_trip"]


def test_small_table_of_words(make_docs, small, monkeypatch):
    c = bpe.codec(PATH, P.PATTERN)
    monkeypatch.setattr(bpe, "CACHE_WORDS", 50)
    texts = [t for _, t in small[:40]]
    enc = library()
    got = [" ".join(w[0] for w in words if w[1]) for k in range(0, 40, 10) for words in bpe.encode_words(c, texts[k:k + 10])]
    assert got == [" ".join(map(str, enc.encode_ordinary(t))) for t in texts]


def test_ids_offsets_and_decoding(make_docs):
    rows = list(enumerate(ODD))
    tokens = bpe.encode(make_docs(rows), PATH, P.PATTERN)
    enc = library()
    for r in tokens.collect():
        text = ODD[r["doc_id"]] or ""
        assert r["ids"] == enc.encode_ordinary(text)
        # a token's span holds its bytes; tokens of a split character share it
        for i, a, b in zip(r["ids"], r["starts"], r["ends"]):
            assert enc.decode_single_token_bytes(i) in text[a:b].encode()
    back = {r["doc_id"]: bytes(r["data"]) for r in bpe.decode_ids(tokens, PATH, P.PATTERN).collect()}
    assert back == {i: (t or "").encode() for i, t in rows}
    assert bpe.round_trip(make_docs([]), PATH, P.PATTERN).count() == 0
    assert sorted(bpe.byte_alphabet()) == sorted(set(bpe.byte_alphabet()))
