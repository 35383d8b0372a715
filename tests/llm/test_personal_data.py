"""Personal data against the plain patterns, planted credentials and long texts."""

import random
import re
import time

from starwright.llm import bpe, pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    def fits(kind, match):
        digits = re.sub("[^0-9]", "", match)
        if kind == "ip":
            return all(int(p) <= 255 for p in match.split("."))
        if kind == "card":
            total = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1]))
            return 14 <= len(digits) <= 19 and total % 10 == 0
        return 10 <= len(digits) <= 15 if kind == "phone" else True

    return sorted((m.start(), kind, m.end()) for kind, p in PLAIN.items()
                  for m in re.finditer(p, text) if fits(kind, m[0]))


def test_base_spans_equal_the_patterns():
    r = random.Random(8)
    parts = ["a.b@x-y.co", "@", ".", "1.2.3.4", "256.1.1.1", "0001.2.3.4.5", "+1 (555) 123-4567",
             "4111 1111 1111 1111", "4111-1111-1111-1111", "378282246310005", " ", "-", "é", "+",
             "7", "00", "token = \"abcdefgh12\"", "x [at] y [dot] com", "\n"]
    for _ in range(4000):
        text = "".join(r.choices(parts, k=r.randint(1, 12)))
        base = sorted((s, pii.KINDS[k], e) for k, s, e, b, _ in pii.candidates(text) if b)
        assert base == plain_spans(text), text


def test_loose_spans_overlap_no_base_span_nor_each_other():
    r = random.Random(9)
    parts = ["555 123 4567 ", "(0123) 456 7890", "a.b@x.com", "token=abcd.ef@gh.ij ", "1.2.3.4",
             "999.2.3.4 ", "4111 1111 1111 1112 ", "me [at] host [dot] org ", " "]
    sure = type("Sure", (), {"score": staticmethod(lambda code: 0.9)})
    for _ in range(2000):
        text = "".join(r.choices(parts, k=8))
        spans = pii.resolve(pii.candidates(text), sure, 0.5)
        for i, (_, s, e, base, _) in enumerate(spans):
            if not base:
                assert not any(s < b and a < e for j, (_, a, b, _, _) in enumerate(spans) if j != i)


def test_planted_credentials_are_found_and_masked(spark):
    secrets = [f"{random.Random(i).getrandbits(160):040x}" for i in range(30)]
    long = "k" + "".join(secrets)
    texts = [f"la. token = \"{s}\" and more" for s in secrets] + [f"api_key: '{long}'"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(99, "a token of thanks: none"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.spans for r in pii.find_personal_data(docs).collect()}
    assert all([s.kind for s in found[i]] == ["secret"] for i in range(31)) and not found[99]
    masked = pii.mask_texts(docs, pii.fit_span_classifier(docs), ["doc_id"]).collect()
    assert not any(s in (r.text or "") for r in masked for s in [*secrets, long])


def test_a_masked_address_of_any_length():
    address = "a" * 500 + " [at] " + "b" * 300 + " [dot] com"
    assert [(s, e) for _, s, e, _, _ in pii.candidates(address)] == [(0, len(address))]


def test_long_texts_take_linear_time():
    unit = "call 555 123 4567 or a.b@x.com token = \"abcd\" 1.2.3.4 a+a+a+ "
    sure = type("Sure", (), {"score": staticmethod(lambda code: 0.9)})

    def seconds(n):
        start = time.perf_counter()
        pii.resolve(pii.candidates(unit * n), sure, 0.5)
        return time.perf_counter() - start

    seconds(100)
    assert seconds(8000) < 40 * seconds(1000)      # eight times the text
    start = time.perf_counter()
    pii.candidates("a+" * 200_000)
    assert time.perf_counter() - start < 20


def test_encoding_with_small_caches(spark):
    ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256, b"abab": 257}
    rows = [(i, "abab x" * (i % 50)) for i in range(500)] + [(None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = bpe.encode_documents(docs, ranks, r"\s?\S+|\s+", entries=3).collect()
    other = bpe.encode_documents(docs, ranks, r"\s?\S+|\s+").collect()
    assert sorted(map(str, got)) == sorted(map(str, other)) and len(got) == 501


def test_texts_encoded_together_equal_the_library():
    import public_tokenizers
    from tokenizers import Tokenizer

    from starwright.llm import token_files
    vocabulary = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()
    texts = ["", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "\n a", "a　 b", "é ü",
             "a\n\n  b", "a <|endoftext|> b", "\t", "a\tb c", "   x", "x  y", "\U0001f600 z",
             "a" * 500 + " b", "word " * 300, *(f"word{i} and word{i + 1}" for i in range(40))]
    want = [e.ids for e in Tokenizer.from_str(vocabulary).encode_batch_fast(
        texts, add_special_tokens=False)]
    for entries in (600_000, 16, 1):
        encoder = token_files.CachedEncoder(vocabulary, entries)
        for _ in range(2):
            got = [token_files.np.frombuffer(x, "<u4").tolist()
                   for x in encoder.encode_all(texts)]
            assert got == want
        assert len(encoder.cache.young) <= entries and len(encoder.cache.old) <= entries
    assert list(token_files._groups(["a" * token_files.CHARACTERS, None, "b"])) == [(0, 2), (2, 3)]
    assert list(token_files._groups([])) == []
