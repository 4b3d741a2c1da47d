import zlib

import numpy as np
import pyarrow as pa
import pytest

from textsift.llm import tokens as T

P = pytest.importorskip("public_tokenizers")
TEXTS = [(3, "Hello world it's 12 o'clock"), (1, None), (2, ""), (7, " \t\n"), (5, "é́ Å H̱  x y İ Σίσυφος ΣΑΣ <|endoftext|> a<|startoftext|>b"),
         (9, "x" * 30000 + " y"), (None, "no id"), (8, "same same same"), (8, "same same same"), (11, "日本語 テキスト \U0001F600\U0001F600 a\x1cb a\x85b"), (10, "a.b,c 'll 've don't l'eau 1,000.50")]
TEXTS += [(100 + i, f"word{i % 7} and {'more ' * (i % 50)}") for i in range(300)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_round_trip_against_plain_encoding(spark, name):
    from tokenizers import Tokenizer
    path = P.path(name)
    df = spark.createDataFrame([(i, t, "x", 5) for i, t in TEXTS], "doc_id long, text string, start string, h int")
    got = T.token_positions(df, path, file_bytes=20000, group_ids=700, block_ids=256).collect()
    plain = Tokenizer.from_file(path)
    start, want = 0, []
    for i, t in sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()
        want.append((i, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert T.token_positions(df.limit(0), path).count() == 0


def test_damage_is_found():
    coded = [np.arange(50, dtype="<u4").tobytes(), np.zeros(1, "<u4").tobytes()]
    data = b"".join(f + b"\n" for f in T.write_group(0, 0, [1, None], coded, 16))
    (part, number, docs, ids), = T.read_groups(data)
    assert (part, number, docs) == (0, 0, [1, None]) and [x.tobytes() for x in ids] == coded
    for at in range(0, len(data), 7):
        bad = bytearray(data)
        bad[at] ^= 1
        with pytest.raises(Exception):  # noqa: B017
            list(T.read_groups(bytes(bad)))


def test_tokenizers_encoded_by_word():
    from tokenizers import Tokenizer, models, normalizers, pre_tokenizers
    load = lambda name: Tokenizer.from_file(P.path(name))
    assert T.drops_spaces(load("word_bpe_49k.json")) and not T.drops_spaces(load("byte_bpe_50k.json"))
    own = Tokenizer(models.BPE())
    assert not T.drops_spaces(own)
    own.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    assert T.drops_spaces(own)
    own.normalizer = normalizers.Replace("  ", "")  # joins words two spaces apart
    assert not T.drops_spaces(own)
    own.normalizer = normalizers.Lowercase()
    own.add_tokens(["new york"])
    assert not T.drops_spaces(own)


def test_words_are_encoded_in_lines(monkeypatch):
    """Words joined to lines have the ids they have alone, those with the mark in them too; known words outlive a task."""
    path = P.path("word_bpe_49k.json")
    words = [w.encode() for w in ["plain", "a~b", "~", "café", "é", "日本", "'s", "don't", "x" * 300, "\x00", " ", "12,5", "|~|", "<unk>"]]
    own = T.WordIds(path)
    alone = {w: np.array(own.tokenizer.encode(w.decode(), add_special_tokens=False).ids, "<u4").tobytes() for w in words}
    asked = []
    monkeypatch.setattr(T.WordIds, "encode", lambda self, texts, f=T.WordIds.encode: asked.append(len(texts)) or f(self, texts))
    for size in (1, 3, 200):
        monkeypatch.setattr(T, "WORDS_A_LINE", size)
        own.clear()
        own.add(set(words))
        assert dict(own) == alone
    own.clear()
    asked.clear()
    own.add({w for w in words if b"~" not in w})
    assert sum(asked) == 1
    monkeypatch.setattr(T, "WORDS_KEPT", 2)
    for _ in range(2):  # the memory is cut: what was met last stays
        own.add({b"plain", b"12,5"})
        assert own.keys() == {b"plain", b"12,5"} and len(own.before) > 1
    assert sum(asked) == 1
    assert T.word_ids(path) is T.word_ids(path)


def test_words_of_letters_skip_the_file_s_pipeline(monkeypatch):
    """Letters, with punctuation behind them or not, have the ids of plain encoding, whatever the letters; they go to the model in lines without marks."""
    path = P.path("word_bpe_49k.json")
    own = T.WordIds(path)
    easy = ["plain", "Plain", "PLAIN", "Straße", "ÉTÉ", "été,", "naïve...", "x" * 300, "word'", "a|;", "foo<|", "ÿ", "Þ", "b)}]", "!?", "'", ""]
    hard = ["\u0130stanbul", "\u212a", "\u212bngstr\u00f6m", "e\u0301te\u0301", "\u0301a", "don't", "'s", "a's,", "a.b", "\u00d7", "a\u00d7b", "\u00f7", "12,5", "a1", "\u65e5\u672c,",
            "\u03a3\u0391\u03a3", "\u01c5", "<|endoftext|>", "a<|startoftext|>b", "\ufb01n", "\u0149", "\u2014", "a\u2014", "\u00a0a", "a\u0085", "\x1ca", "#a"]
    asked = []
    monkeypatch.setattr(T.WordIds, "encode", lambda self, texts, f=T.WordIds.encode: asked.extend(texts) or f(self, texts))
    for _ in range(2):
        got = own.of_words(pa.array(easy + hard, pa.string())).to_pylist()
        assert got == [np.array(own.tokenizer.encode(w, add_special_tokens=False).ids, "<u4").tobytes() for w in easy + hard]
    assert len(asked) == 1 and not {"plain", "straße", "été"} & set(asked[0].lower().split())
    monkeypatch.setattr(own.letters, "usable", False)
    assert own.of_words(pa.array(easy + hard, pa.string())).to_pylist() == got
    own.letters.usable = True
    monkeypatch.setattr(T, "LETTERS_KEPT", 2)
    for _ in range(3):  # the memory is cut
        assert own.of_words(pa.array(easy + hard, pa.string())).to_pylist() == got


def test_other_files_are_encoded_as_they_say(tmp_path):
    from tokenizers import Tokenizer, pre_tokenizers
    path = str(tmp_path / "own.json")
    words = pa.array(["Plain", "été,", "new", "york!", "plain?"])
    for change in (lambda t: setattr(t, "pre_tokenizer", pre_tokenizers.WhitespaceSplit()), lambda t: t.add_tokens(["new"]), lambda t: t.add_tokens(["k!"])):
        own = Tokenizer.from_file(P.path("word_bpe_49k.json"))
        change(own)
        own.save(path)
        got = T.WordIds(path)
        assert not got.letters.usable
        assert got.of_words(words).to_pylist() == [np.array(own.encode(w, add_special_tokens=False).ids, "<u4").tobytes() for w in words.to_pylist()]


def test_a_word_is_one_number(monkeypatch):
    """A group lists the ids of a word once, and codes a number for each word, not for each id."""
    own, texts = T.WordIds(P.path("word_bpe_49k.json")), ["onorheat  thanheha, \n", "", "Thanheha, onorheat onorheat"] * 50
    plain = [[*own.tokenizer.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    made = own.runs(pa.chunked_array([texts[:7], texts[7:]], pa.string()), 2)
    monkeypatch.setattr(T, "BLOCKS_AT_ONCE", 3)
    data = b"".join(f + b"\n" for f in T.write_runs(0, 1, list(range(150)), *made, 16))
    (part, number, docs, ids), = T.read_groups(data)
    assert (part, number, docs, [x.tolist() for x in ids]) == (0, 1, list(range(150)), plain)
    blocks = [p for kind, p in T.frames(data) if kind == b"B"]
    assert sum(int.from_bytes(p[:4], "little") for p in blocks) == 50 * 5 + 150 < sum(map(len, plain)) // 2
