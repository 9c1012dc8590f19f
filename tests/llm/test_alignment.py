import hashlib
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from opsledger.llm import queries, token_alignment
from opsledger.llm.bpe import byte_letters
from tests import oracle

A, B = queries.vocabulary("byte_bpe_50k.json"), queries.vocabulary("piece_bpe_32k.model")


def spans(tokens):
    at, out = 0, []
    for i, b in tokens:
        out.append((i, at, at + len(b)))
        at += len(b)
    return out


def brute(rows):
    """The rows of the operator from the libraries, token by token."""
    a_model, b_model = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_model.encode_special_tokens = True
    value = {c: i for i, c in enumerate(byte_letters())}
    counts, made = Counter(), []
    for key, text in rows:
        a = b = []
        if text:
            a = [(i, bytes(value[c] for c in a_model.id_to_token(i))) for i in a_model.encode(" " + text, add_special_tokens=False).ids]
            b = [(i, bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("▁", " ").encode())
                 for i in b_model.encode(text)]
            if any(b"".join(x for _, x in t) != b" " + text.encode() for t in (a, b)):
                a = b = []
        a, b = spans(a), spans(b)
        links, start = [], 0
        for i, lo, hi in a:
            while b[start][2] <= lo:
                start += 1
            for j, x, _ in b[start:]:
                if x >= hi:
                    break
                links.append((i, j))
        groups, at_a, at_b = [], 0, 0
        for end in sorted({x[2] for x in a} & {x[2] for x in b}):
            parts = []
            for t, at in ((a, at_a), (b, at_b)):
                stop = at
                while stop < len(t) and t[stop][2] <= end:
                    stop += 1
                parts.append((",".join(str(x[0]) for x in t[at:stop]), stop))
            at_a, at_b = parts[0][1], parts[1][1]
            groups.append(f"{parts[0][0]}|{parts[1][0]}")
        counts.update(set(links))
        made.append((key, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    top = {}
    for (i, _), n in counts.items():
        top[i] = max(top.get(i, 0), n)
    return Counter((k, n, m, g, len(x), sum(counts[p] == top[p[0]] for p in x), sum(counts[p] for p in x), h) for k, n, m, g, x, h in made)


def test_odd_rows_equal_brute_force(spark, odd, empty):
    more = spark.createDataFrame([(20, "has ▁ in it"), (21, "<s> </s> <unk> <|endoftext|> plain"), (22, " \n\t double  spaces\r\n"),
                                  (23, "日本語テキスト 😀😀 ñandú"), (24, "aaaaaaaaaaaaaaaaa"), (24, "aaaaaaaaaaaaaaaaa")],
                                 "doc_id bigint, text string")
    docs = odd.select("doc_id", "text").union(more)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute(rows)
    for block in (1, 1 << 23):
        found = Counter(tuple(r) for r in token_alignment.align_tokens(docs, A, B, block_bytes=block).collect())
        assert found == want
    by = {r[0]: r for r in want}
    assert by[20][1:] == (0, 0, 0, 0, 0, 0, "") and by[1][7] == "" and by[21][1] > 0
    assert token_alignment.align_tokens(odd, A, B).columns[0] == "doc_id"
    assert token_alignment.align_tokens(empty, A, B).count() == 0


def test_given_documents_equal_brute_force(spark):
    docs = queries.table(spark, oracle.folder("0.001"), "documents")
    found = Counter(tuple(r) for r in queries.op13_token_alignment(spark, oracle.folder("0.001")).collect())
    assert found == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_rank_file_gives_the_same_tokens():
    one, other = token_alignment.aligner(A, B), token_alignment.aligner(queries.vocabulary("byte_bpe_50k.tiktoken"), B)
    assert one.bytes_a == other.bytes_a


@pytest.mark.parametrize("text", ["a", "word", " x", "ü", "\0"])
def test_short_texts(text):
    numbers, digests, links = token_alignment.aligner(A, B).align([text, None, text])
    assert numbers["n_links"].tolist()[0] == numbers["n_links"].tolist()[2] and numbers["n_links"][1] == 0 and digests[1] == ""
    assert (numbers["n_links"] == numbers["n_a"] + numbers["n_b"] - numbers["n_groups"]).all() and len(links[0]) == numbers["n_links"].sum()
