"""Word lookups give the ids that the tokenizer gives whole texts."""

import random

import numpy as np

from docweave.llm import packing


def test_ids_equal_the_tokenizers_ids(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 500)
    encoder, draw = packing.WordEncoder(packing.default_tokenizer()), random.Random(3)
    pool = [*map(chr, range(0x250)), *"'streets' don't we'll \n\t\x1c\x85\xa0" * 9, *"İΣς́ẞ’—€漢😀①½Ⅷɖ" * 5, "[CLS]", "</s>", "</w>", "x" * 70]
    texts = ["".join(draw.choice(pool) for _ in range(draw.randrange(80))) for _ in range(3000)]
    for at in range(0, len(texts), 250):
        part = texts[at:at + 250]
        want = encoder.tokenizer.encode_batch(part, add_special_tokens=False)
        assert encoder.ids(part) == [np.asarray(w.ids, "<u4").tobytes() for w in want]
