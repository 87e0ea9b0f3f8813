"""Field spans beside base spans, and the runs that train the field."""

import numpy as np

from pawprint.llm import secret_scan


class Tags:
    """A field that tags a begin and glued tokens inside."""

    def viterbi(self, slots, allowed):
        tags = np.zeros(len(allowed), np.int8)
        for i in range(len(allowed)):
            if allowed[i, secret_scan.I] and i and tags[i - 1]:
                tags[i] = secret_scan.I
            elif allowed[i, secret_scan.B]:
                tags[i] = secret_scan.B
        return tags


def test_field_spans_keep_what_base_spans_leave():
    for text, left in (("key 0123456789abcdef0XYZqrst+77Tail here", ["XYZqrst+77Tail"]),
                       ("key Zy9xQ/0123456789abcdef0123/tAilZ81 here", []),
                       ("key Zy9xQ7/0123456789abcdef0123/tAilZ81 here", ["Zy9xQ7/", "/tAilZ81"]),
                       ("key 0123456789abcdef here", [])):
        base = secret_scan.base_spans(text)
        assert base
        found = secret_scan.field_spans(text, Tags(), base)
        if left:
            assert [text[a:b] for _, a, b in found] == left
        assert not any(x < b and a < y for _, a, b in found for _, x, y in base)


def test_training_runs_come_from_the_whole_text():
    text = " filler words of no use at all ".join(
        f"item{k:04d}x" + " and some plain words that follow it for a while" for k in range(300))
    runs = secret_scan.training_runs(text)
    assert len(runs) == 20 < len(secret_scan.sequences(text))
    starts = [r[0][1] for r in runs]
    assert starts == sorted(starts) and starts[-1] > len(text) // 2
    assert secret_scan.training_runs(text) == runs
    long = " ".join(f"item{k:04d}x" for k in range(500))
    assert [len(r) for r in secret_scan.training_runs(long)] == [64]
