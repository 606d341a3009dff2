import pytest

from cinerank.llm.token_counts import VOCABULARY, Counter, count_tokens, load_vocabulary
from tests.llm.texts import documents, empty

tokenizers = pytest.importorskip("tokenizers")

ODD = ["日本語 テスト", "<0x41> <s> a▁b ▁▁x ▁", "", "x" * 3000, "   é é 😀😀 ", "ａｂ c"]


def reference(pieces, unknown, bytes_known):
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    own = Tokenizer(models.Unigram(pieces, unk_id=unknown, byte_fallback=bytes_known))
    own.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex("[\\x20\\x09-\\x0D]+"), "removed"),
        pre_tokenizers.Metaspace("▁", prepend_scheme="always", split=True)])
    return lambda text: len(own.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("bytes_known", [True, False])
def test_equal_to_the_tokenizer(spark, bytes_known):
    pieces, _ = load_vocabulary(VOCABULARY)
    exact, counter = reference(pieces, 0, bytes_known), Counter(pieces, bytes_known)
    texts = ODD + [r[0] or "" for r in documents(spark).select("text").collect()]
    assert [counter.count(t)[1] for t in texts] == [exact(t) for t in texts]


def test_ties_go_to_the_longest_last_piece():
    pieces = [("<unk>", -9.0), ("▁", -1.0), ("a", -1.0), ("aa", -2.0), ("▁a", -2.0), ("▁aa", -3.0)]
    exact, counter = reference(pieces, 0, False), Counter(pieces, False)
    for text in ("a", "aa", "aaa", "aaaa b", "bb a b", "aabaa"):
        assert counter.count(text)[1] == exact(text)


def test_rows(spark):
    pieces, known = load_vocabulary(VOCABULARY)
    docs = documents(spark)
    out = count_tokens(docs, pieces, known)
    assert out.count() == docs.count()
    assert {(r["n_words"], r["n_tokens"]) for r in out.where("doc_id in (200, 201, 202, 203)").collect()} == {(0, 0)}
    assert count_tokens(empty(spark), pieces, known).collect() == []
