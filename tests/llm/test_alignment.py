"""Aligned tokenizers against a plain version that goes token by token."""

import hashlib
import os
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tillwright.llm import alignment, queries
from tillwright.llm.tokens import byte_letters

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    """``rows -> results``: the contract read literally, one text, one token and one link at a time."""
    first, letters = Tokenizer.from_file(A_PATH), byte_letters()
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=B_PATH)

    def b_bytes(n):
        piece = second.id_to_piece(n)
        return bytes([int(piece[3:5], 16)]) if second.is_byte(n) else piece.replace("▁", " ").encode()

    def groups_of(text):
        if not text:
            return []
        a = [(n, bytes(letters[c] for c in first.id_to_token(n))) for n in first.encode(" " + text, add_special_tokens=False).ids]
        b = [(n, b_bytes(n)) for n in second.encode(text)]
        if not b"".join(x for _, x in a) == b"".join(x for _, x in b) == (" " + text).encode():
            return []
        groups, left, right, i, j = [], [], [], 0, 0
        a_end = b_end = 0
        while i < len(a) or j < len(b):
            if a_end <= b_end:
                left.append(a[i][0])
                a_end += len(a[i][1])
                i += 1
            else:
                right.append(b[j][0])
                b_end += len(b[j][1])
                j += 1
            if a_end == b_end:
                groups.append((left, right))
                left, right = [], []
        return groups

    def results(rows):
        found = [(key, groups_of(text)) for key, text in rows]
        links = [Counter((a, b) for left, right in groups for a in left for b in right) for _, groups in found]
        counts = Counter(pair for one in links for pair in one)
        best = defaultdict(int)
        for (a, _), n in counts.items():
            best[a] = max(best[a], n)
        out = []
        for (key, groups), one in zip(found, links):
            told = ";".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in groups)
            out.append((
                key, sum(len(x) for x, _ in groups), sum(len(x) for _, x in groups), len(groups), sum(one.values()),
                sum(n for pair, n in one.items() if counts[pair] == best[pair[0]]), sum(n * counts[pair] for pair, n in one.items()),
                hashlib.sha256(told.encode()).hexdigest() if told else "",
            ))
        return out, counts

    return results


ODD = [
    None, "", " ", "a", "  two  spaces\t\n\n", "<|endoftext|> and <s> </s> <unk>", "<0x41> is no byte", "x▁y", "ﬁsh é", "中文 \U0001f600\U0001f600",
    "a" * 3000, "ab éß " * 400, "\x00 null", "Same text twice, same text twice.", "Same text twice, same text twice.", "1234567890 " * 50, "\r\nline\r\n",
]


def _rows(frame):
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return sorted((tuple(row[name] for name in names) for row in frame.collect()), key=repr)


@pytest.mark.parametrize("parts", [1, 3])
def test_odd_texts_against_the_plain_version(spark, plain, parts, monkeypatch):
    draw = random.Random(7)
    words = ["the", "Straße", "naïve", "don't", "2024", "--", "été", "\n", "  ", "überall", "x" * 30, "%%%", "日本"]
    texts = ODD + [" ".join(draw.choices(words, k=draw.randint(1, 60))) for _ in range(40)]
    rows = [(n if n % 7 else None, text) for n, text in enumerate(texts)]
    docs = spark.createDataFrame([(*row, "x", 1) for row in rows], "doc_id bigint, text string, block string, rows int").repartition(parts)
    assert _rows(alignment.alignment_digests(docs, A_PATH, B_PATH)) == sorted(plain(rows)[0], key=repr)


def test_small_blocks_and_slices_change_nothing(spark, plain, monkeypatch):
    for name, value in (("BLOCK_CHARS", 100), ("BLOCK_PAIRS", 5), ("EXPANDED", 3), ("LONG", 50)):
        monkeypatch.setattr(alignment, name, value)
    aligner = alignment.Aligner(open(A_PATH, encoding="utf-8").read(), open(B_PATH, "rb").read())
    texts = [text for text in ODD if text]
    found = aligner.aligned(texts)
    expected, counts = plain(list(enumerate(texts)))
    told = [hashlib.sha256(groups).hexdigest() if groups else "" for groups in found.spelled()]
    assert told == [row[7] for row in expected] and found.n_links.tolist() == [row[4] for row in expected]
    (_, same_a, _), (_, a, b, _) = found.pairs()
    assert Counter(zip(a.tolist(), b.tolist())) + Counter(zip(same_a.tolist(), aligner.same[same_a].tolist())) == counts


def test_generated_documents_against_the_plain_version(spark, plain):
    docs = queries.documents(spark, SF_DIR)
    rows = [tuple(row) for row in docs.select("doc_id", "text").collect()]
    expected, counts = plain(rows)
    assert _rows(queries.op12_tokenizer_alignment(spark, SF_DIR)) == sorted(expected, key=repr)
    found = alignment.aligned(docs, A_PATH, B_PATH)
    assert {(row["a"], row["b"]): row["rows"] for row in found.counts().collect()} == counts


def test_keys_empty_tables_and_kept_groups(spark):
    docs = spark.createDataFrame([("k", "Hello world"), (None, None)], "doc_id string, text string")
    found = alignment.alignment_digests(docs, A_PATH, B_PATH)
    assert dict(found.dtypes)["doc_id"] == "string" and {row["doc_id"] for row in found.collect()} == {"k", None}
    assert alignment.alignment_digests(docs.limit(0), A_PATH, B_PATH).collect() == []
    told = {row["doc_id"]: row["groups"] for row in alignment.aligned_groups(docs, A_PATH, B_PATH).collect()}
    assert told[None] == "" and hashlib.sha256(told["k"].encode()).hexdigest() in {row["groups_sha256"] for row in found.collect()}
