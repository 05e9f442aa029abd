"""Words are tokenized by parts: the ids are those of whole texts, and words that share a part pay for it once."""

import random

import numpy as np
import pyarrow as pa

from petrichor.llm import packing
from petrichor.llm.words import text_buffer

TOKENIZER = packing.default_tokenizer()


def _ids(texts):
    ids, bounds = packing.WordTokens(TOKENIZER).encode(*text_buffer(pa.array(texts, pa.string())), 2)
    return [ids[a : b - 1].tolist() for a, b in zip(bounds, bounds[1:])]


def test_parts_equal_whole_texts():
    rng = random.Random(7)
    signs = "aBcXz09.,;'<|>=-_` \t\ń̸̈éÉßÿ×÷ÀÞŠšİı日ΑΣσ😀K\x00\x1c\x85\xa0"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(40))) for _ in range(3000)]
    texts += ["it's I'LL 'Re a<|endoftext|>b <|startoftext|>", "É" * 2000 + "'S", "2024-01-15,x=y", "(é) ≮ ≠", "Ça, Été!", ""]
    whole = packing.WordTokens(TOKENIZER).tokenizer.encode_batch(texts, add_special_tokens=False)
    assert _ids(texts) == [e.ids for e in whole]


def test_words_with_and_without_marks_are_remembered_once():
    tokens = packing.WordTokens(TOKENIZER)
    texts = pa.array(["Regen regen, (REGEN) regen... «regen» 2024 4202", None, "regen; Éré éré!"], pa.string())
    tokens.encode(*text_buffer(texts), 2)
    # regen , ( ) ... 2 0 4 ; éré ! and «regen», whose marks are of another kind
    assert len(tokens.keys) == 12


def test_other_tokenizers_get_whole_words(tmp_path):
    from tokenizers import Tokenizer, pre_tokenizers

    other = Tokenizer.from_file(TOKENIZER)
    other.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    other.save(str(tmp_path / "other.json"))
    tokens = packing.WordTokens(str(tmp_path / "other.json"))
    ids, bounds = tokens.encode(*text_buffer(pa.array(["a,b a,b 12", "x"], pa.string())), 2)
    whole = other.encode_batch(["a,b a,b 12", "x"], add_special_tokens=False)
    assert [ids[a : b - 1].tolist() for a, b in zip(bounds, bounds[1:])] == [e.ids for e in whole]
    assert len(tokens.keys) == 3


def test_memory_of_ids_is_bounded(monkeypatch):
    """Parts of many ids make a worker forget, too."""
    monkeypatch.setattr(packing, "REMEMBERED", 8)
    tokens = packing.WordTokens(TOKENIZER)
    for c in "bcdfg":
        tokens.encode(*text_buffer(pa.array([f"{c}xqz" * 40], pa.string())), 2)
        assert len(np.unique(tokens.keys)) == len(tokens.keys) <= 1


def test_a_batch_is_parted_in_small_chunks_by_one_tokenizer(monkeypatch):
    """A worker's arrays follow ``TEXT_BYTES``, not the batch, and it holds one tokenizer, in its own state again after plain parts."""
    monkeypatch.setattr(packing, "TEXT_BYTES", 100)
    batch = pa.RecordBatch.from_arrays([pa.array(range(40)), pa.array([f"word{i} " * 5 for i in range(40)])], ["doc_id", "text"])
    found = list(packing._tokens(TOKENIZER, 2, np.dtype("<u2"))(iter([batch])))
    assert len(found) >= 10 and sum(len(b) for b in found) == 40
    tokens = packing.WordTokens(TOKENIZER)
    before = tokens.tokenizer.to_str()
    tokens.encode(*text_buffer(batch["text"]), 2)
    assert tokens.split and tokens.tokenizer.to_str() == before
    assert sum(type(v) is type(tokens.tokenizer) for v in vars(tokens).values()) == 1
