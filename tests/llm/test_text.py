"""Word pieces, byte-level BPE and personal data."""

import hashlib
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from vesselmart.llm import bpe, pii, wordpieces  # noqa: E402

from .helpers import documents  # noqa: E402

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = [
    None, "", " ", "a", "  a\n\n b", "<|endoftext|>", "x<|endoftext|>y", "don't I'LL we've", "a\x85b\x1cc\u2003d",
    "\u00e9" * 300, "ab" * 400, "1234567 12 \u00bd", "\u5bb6\u65cf \U0001f469\u200d\U0001f469", "same", "same",
]


def test_encoding_agrees_with_the_library(spark):
    draw = random.Random(4)
    texts = ODD + ["".join(draw.choices("ab \n\t.\u00e91'\u6771s", k=60)) for _ in range(200)] + ["x" * 30_000]
    want = Tokenizer.from_file(JSON)
    rows = {r["doc_id"]: r for r in bpe.round_trip(documents(spark, texts), JSON).collect()}
    assert len(rows) == len(texts)
    for k, text in enumerate(texts):
        ids = want.encode(text or "", add_special_tokens=False).ids
        packed = np.array(ids, "<u4").tobytes()
        decoded = want.decode(ids, skip_special_tokens=False)
        got = rows[k]
        assert got["n_tokens"] == len(ids)
        assert got["ids_sha256"] == hashlib.sha256(packed).hexdigest()
        assert got["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_encode_and_decode_keep_other_columns(spark):
    df = documents(spark, ODD, ids="clash", rank="kept")
    back = bpe.decode(bpe.encode(df, JSON), JSON)
    rows = back.collect()
    assert back.columns == ["doc_id", "text", "lang", "source", "n_chars", "rank", "ids", "decoded"]
    assert all(r["decoded"] == (r["text"] or "") and r["rank"] == "kept" for r in rows)
    assert bpe.round_trip(documents(spark, []), JSON).count() == 0
    both = bpe.with_ids(df.withColumnRenamed("rank", "decodes"), JSON)
    assert both.columns == ["doc_id", "lang", "source", "n_chars", "ids", "decodes"]
    want = {r["doc_id"]: r["ids"] for r in rows}
    assert all(r["decodes"] and r["ids"] == want[r["doc_id"]] for r in both.collect())


def test_rows_of_null_and_repeated_ids_are_encoded_each(spark):
    df = documents(spark, [(None, "ab"), (4, "ab"), (4, "ab"), (4, "cd"), (None, None)])
    assert sorted(r["n_tokens"] for r in bpe.round_trip(df, JSON).collect()) == [0, 1, 1, 1, 1]
    counted = wordpieces.count_pieces(df, RANKS).collect()
    assert sorted((r["doc_id"] or 0) for r in counted) == [0, 0, 4, 4, 4]


def test_a_piece_of_a_million_letters(spark):
    text = "ab" * 500_000
    got = bpe.round_trip(documents(spark, [text]), JSON).first()
    assert got["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert got["n_tokens"] <= 500_000


def test_a_full_memory_starts_anew():
    codec = bpe.Codec(bpe.Vocabulary(open(JSON, encoding="utf-8").read()))
    first = codec.encode(["some words here"])
    codec.used = bpe.MEMORY + 1
    assert codec.encode(["other words"]) and codec.used < 10_000
    assert codec.encode(["some words here"]) == first


def test_one_tree_and_many_agree():
    vocab = bpe.Vocabulary(open(JSON, encoding="utf-8").read())
    draw = random.Random(5)
    pieces = [bytes(draw.choices(b"thanigerd\xc3\xa9 ", k=draw.randint(1, 32))) for _ in range(500)]
    many = bpe.merge_many(pieces, 32, vocab)
    for piece, packed in zip(pieces, many):
        one = bpe.merge_one(vocab.symbols(piece), vocab)
        assert np.frombuffer(packed, "<u4").tolist() == one.tolist()


def _greedy(word, vocabulary):
    count = 0
    while word:
        length = next((k for k in range(len(word), 0, -1) if word[:k] in vocabulary), 1)
        word, count = word[length:], count + 1
    return count


@pytest.mark.parametrize("small", [True, False])
def test_automaton_counts_greedy_pieces(small):
    draw = random.Random(6)
    pieces = [b"ab", b"abcd", b"bc", b"bcdx", b"cdxa"] if small else wordpieces.read_pieces(open(RANKS).read())
    letters = b"abcdx" if small else b"thesandi.\xc3\xa9\xff"
    words = [bytes(draw.choices(letters, k=draw.randint(0, 30))) for _ in range(3000)] + [b""]
    vocabulary = set(pieces)
    assert wordpieces.Automaton(pieces).counts(words).tolist() == [_greedy(w, vocabulary) for w in words]


def test_piece_counts_of_documents(spark):
    texts = [None, "", " \t\n", "the cat", "the  cat\n", "\u00e9t\u00e9 " * 5, "z" * 5000]
    vocabulary = set(wordpieces.read_pieces(open(RANKS).read()))
    df = documents(spark, texts, n_words="clash")
    rows = {r["doc_id"]: tuple(r)[1:] for r in wordpieces.count_pieces(df, RANKS).collect()}
    for k, text in enumerate(texts):
        words = (text or "").encode().split()
        assert rows[k] == (len(words), sum(_greedy(b" " + w, vocabulary) for w in words))
    assert wordpieces.count_pieces(documents(spark, []), RANKS).count() == 0


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _luhn(digits):
    doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def _plain(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    return {
        "email": [m.span() for m in EMAIL.finditer(text)],
        "ip": [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))],
        "card": [m.span() for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and _luhn(digits(m))],
        "phone": [m.span() for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15],
    }


@pytest.mark.parametrize("letters", ["ab1.@-+ ", "0123456789 -", "+1 ().-a23", "1.25 9", "a@.b"])
def test_base_spans_follow_the_patterns(letters):
    draw = random.Random(7)
    for _ in range(4000):
        text = "".join(draw.choices(letters, k=draw.randint(0, 40)))
        assert pii.find_plain(text) == _plain(text)


DISGUISED = [
    ("write to john.doe [at] example [dot] com now", "email", "john.doe [at] example [dot] com"),
    ("jane at example dot com!", "email", "jane at example dot com"),
    ("bob(at)host.org", "email", "bob(at)host.org"),
    ("j\u043ehn@ex\u0430mple.com", "email", "j\u043ehn@ex\u0430mple.com"),
    ("call plus one five five five one two three four five six seven", "phone",
     "plus one five five five one two three four five six seven"),
    ("one nine two dot one six eight dot one dot one", "ip", "one nine two dot one six eight dot one dot one"),
    ("\uff14\uff11\uff11\uff11 \uff11\uff11\uff11\uff11 \uff11\uff11\uff11\uff11 \uff11\uff11\uff11\uff11", "card", None),
]


@pytest.mark.parametrize("text,kind,span", DISGUISED)
def test_disguises_map_back_to_the_source(text, kind, span):
    plain, every = pii.find_all(text)
    assert [text[a:b] for a, b in every[kind]] == [span or text] and not plain[kind]
    assert not any(every[k] for k in pii.KINDS if k != kind)


@pytest.mark.parametrize("text", [
    "meet me at noon", "one two three", "a dot on the map", "look at a.b", "\u00e9t\u00e9 \u00e0 la plage, un deux",
    "one of two or three at five", "in 2020 at example", "",
])
def test_ordinary_texts_stay_alone(text):
    assert pii.find_all(text) == (pii.find_plain(text), pii.find_plain(text))


AT, DOT = ["@", " at ", " AT ", "[at]", " (at) ", " {@} "], [".", " dot ", " Punkt ", "[dot]", " (.) ", " point "]


def _added(text):
    """Spans through the trigger, as over a table."""
    (plain, every), = pii.find_each(pa.array([text]))
    return {k: [text[a:b] for a, b in every[k] if (a, b) not in plain[k]] for k in pii.KINDS}, plain


def test_every_mix_of_signs_is_found():
    found = total = 0
    for at, one, two in itertools.product(AT, DOT, DOT):
        if (at, one, two) == ("@", ".", "."):
            continue
        for core in (f"john.d{at}mail{one}example{two}org", f"ann{at}example{two}com"):
            if core == "ann@example.com":
                continue
            added, plain = _added(f"Please, {core}, thanks")
            total += 1
            if plain["email"]:  # "john.d@mail.example dot org" holds a plain address
                assert plain["email"] and "@" in core and "." in core
            else:
                found += 1
                assert added["email"] == [core] and not added["ip"]
    assert found > 0.9 * total
    for dots in itertools.product(DOT, repeat=3):
        core = f"192{dots[0]}168{dots[1]}1{dots[2]}12"
        added, plain = _added(f"host {core}, up")
        assert plain["ip"] if set(dots) == {"."} else added["ip"] == [core]
    assert not _added("300 dot 168 dot 1 dot 1")[0]["ip"]


@pytest.mark.parametrize("text", [
    "look at example.com", "Meet us at example.org now", "he works at Example.com", "we were at v2.0 then", "at example.com",
    "a 3 point 5 rise", "on 1 dot 2 dot 3", "mail @host point taken", "see at a.b", "at noon. Then at nine.",
    "scored 3 point 5 point 7 on it", " " * 20_000 + "at" + " " * 20_000, "9" * 20_000 + " dot 1 dot 1 dot 1",
])
def test_ordinary_dots_and_words_stay_alone(text):
    assert not any(_added(text)[0].values())


def test_detection_over_a_table(spark):
    texts = [None, "", "a@b.co 1.2.3.4", "a@b.co 1.2.3.4", "x " * 50_000 + "p at q dot org", "4111 1111 1111 1111 +1 (555) 123-4567"]
    df = documents(spark, texts, spans="clash", n_email="clash")
    rows = {r["doc_id"]: r for r in pii.detect(df).collect()}
    for k, text in enumerate(texts):
        plain = _plain(text or "")
        listed = ",".join(f"{kind}:{a}:{b}" for kind in pii.KINDS for a, b in plain[kind])
        assert [rows[k][f"n_{kind}"] for kind in pii.KINDS] == [len(plain[kind]) for kind in pii.KINDS]
        assert rows[k]["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert set(listed.split(",")) <= set(rows[k]["spans"].split(",")) or not listed
    assert rows[4]["n_added"] == 1 and rows[4]["spans"] == "email:100000:100014"
    masked = {r["doc_id"]: r["text"] for r in pii.mask(df).collect()}
    assert masked[0] is None and masked[1] == "" and masked[2] == "<email> <ip>" == masked[3]
    assert masked[4].endswith("x <email>")
    assert pii.mask(df).columns == df.columns and pii.detect(documents(spark, [])).count() == 0
