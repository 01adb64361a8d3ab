import hashlib
import json
from collections import Counter
from pathlib import Path

import corpus
import pytest

from acctpulse.llm import crosstok
from acctpulse.llm.queries import TOKENIZERS

FILES = [Path(TOKENIZERS, n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
pytestmark = pytest.mark.skipif(not all(f.exists() for f in FILES), reason="no vocabulary files")
VOCABULARY, MODEL = (f.read_bytes() if f.exists() else b"" for f in FILES)


def encoders():
    """The libraries as they are, and each id's bytes."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_str(VOCABULARY.decode())
    a.encode_special_tokens = True
    letters = crosstok.byte_letters()
    of_id = {i: bytes(letters.get(c, 0) for c in t) for t, i in json.loads(VOCABULARY)["model"]["vocab"].items()}
    b = sentencepiece.SentencePieceProcessor(model_proto=MODEL)

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    return (
        lambda t: [(i, of_id[i]) for i in a.encode(" " + t, add_special_tokens=False).ids],
        lambda t: [(i, piece(i)) for i in b.encode(t)],
    )


def brute(texts):
    """Measures per text, straight from the definition."""
    code_a, code_b = encoders()
    told = []
    for text in texts:
        whole = (" " + text).encode() if text else b""
        a, b = (code_a(text), code_b(text)) if text else ([], [])
        if any(b"".join(p for _, p in side) != whole for side in (a, b)):
            a, b = [], []
        ends = []
        for side in (a, b):
            at, place = 0, {}
            for k, (_, p) in enumerate(side):
                at += len(p)
                place[at] = k
            ends.append(place)
        groups, links, i, j = [], [], 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            ka, kb = ends[0][end], ends[1][end]
            groups.append(",".join(str(x) for x, _ in a[i : ka + 1]) + "|" + ",".join(str(x) for x, _ in b[j : kb + 1]))
            links.append((a[ka][0], b[kb][0]))
            i, j = ka + 1, kb + 1
        told.append((len(a), len(b), groups, links))
    count = Counter(p for *_, links in told for p in links)
    highest = {}
    for (_, y), n in count.items():
        highest[y] = max(highest.get(y, 0), n)
    return [
        (n_a, n_b, len(groups), len(links), sum(count[p] == highest[p[1]] for p in links), sum(count[p] for p in links),
         hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "")
        for n_a, n_b, groups, links in told
    ]


AWKWARD = [
    "a", " ", "  two  spaces  ", "tab\tand\nline\r\n", "<|endoftext|> <s> <unk> <0x41>", "▁ low line", "été \U0001f600 中文",
    "é ﬁ ①  x", "\x00 null", "x" * 3000, " " * 500 + "y", "it's we'll 12 345", "a▁ b c", "a ▁b c",
]


def test_measures_equal_the_definition(spark):
    data = corpus.rows(80) + [r for r in corpus.awkward() if r[0] != 1006]
    data += [(2000 + i, t, None, None, None) for i, t in enumerate(AWKWARD)]
    data += [(3000 + i, "copied text, often copied text", "en", "src0", 1) for i in range(60)]
    got, totals = crosstok.cross_align(corpus.frame(spark, data, True), ["doc_id"], VOCABULARY, MODEL)
    columns = [*crosstok.MEASURES, "groups_sha256"]
    told = sorted((str(r.doc_id), *[r[c] for c in columns]) for r in got.collect())
    expected = brute([r[1] for r in data])
    assert told == sorted((str(r[0]), *e) for r, e in zip(data, expected, strict=True))
    assert got.columns == ["doc_id", *columns]
    # a join by shuffle gives the same
    other, _ = crosstok.cross_align(corpus.frame(spark, data), ["doc_id"], VOCABULARY, MODEL, 0)
    assert told == sorted((str(r.doc_id), *[r[c] for c in columns]) for r in other.collect())


def test_cutting_changes_nothing():
    tool = crosstok.aligner(VOCABULARY, MODEL)
    for text in [r[1] for r in corpus.rows(20, 3)] + AWKWARD + [corpus.awkward()[6][1]]:
        whole, cut = tool.align(text, 1 << 30), tool.align(text, 7)
        assert whole[:4] == cut[:4] and whole[6] == cut[6]
        assert whole[4].tolist() == cut[4].tolist() and whole[5].tolist() == cut[5].tolist()


def test_the_quicker_encoder_gives_the_files_own_ids():
    code_a, _ = encoders()
    tool = crosstok.aligner(VOCABULARY, MODEL)
    points = [c for c in range(0, 0x30000, 7) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(points), 400):
        text = " ".join(f"a{chr(c)}1{chr(c)}{chr(c)}" for c in points[i : i + 400])
        assert tool.a.encode(" " + text) == [i for i, _ in code_a(text)]


def test_empty_and_null_tables(spark):
    got, _ = crosstok.cross_align(corpus.frame(spark, []), ["doc_id"], VOCABULARY, MODEL)
    assert got.collect() == []
    got, _ = crosstok.cross_align(corpus.frame(spark, [(1, None, None, None, None)]), ["doc_id"], VOCABULARY, MODEL)
    assert got.collect()[0].asDict() == {"doc_id": 1, **dict.fromkeys(crosstok.MEASURES, 0), "groups_sha256": ""}
