"""Ids that are found piece by piece."""

from __future__ import annotations

import random
import re

import numpy as np

from tallyward.llm.common import _END_MARKS, WordIds, read_whole, tokenizer_path


def test_ids_of_pieces_are_found_for_many_at_once():
    ids_of = WordIds(read_whole(tokenizer_path()))
    pieces = ["", "word", "Straße.", ".", "", "x" * 300, "İ!", "日本", *map(str, range(1000)), ""]
    found = list(ids_of._codes([p.encode() + b" " for p in pieces]))
    assert [len(sizes) for _, sizes in found] == [512, len(pieces) - 512]
    ids, sizes = (np.concatenate(side) for side in zip(*found))
    alone = [ids_of.tokenizer.encode(p, add_special_tokens=False).ids for p in pieces]
    assert sizes.tolist() == [len(a) for a in alone] and ids.tolist() == [i for a in alone for i in a]


def test_marks_that_end_a_word():
    plain = re.compile(r"(?<=[^\W_İ])[.,!?;:%#$&*|]+(?=[ \n])")
    draw = random.Random(4)
    for _ in range(20_000):
        text = "".join(draw.choice("aZ1_İı .,!|\n\t-²日") for _ in range(draw.randrange(12)))
        assert _END_MARKS.findall(text + " ") == plain.findall(text + " ")
