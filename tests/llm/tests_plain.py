"""Plain versions that several tests use."""

import zlib

import numpy as np

from lawloom.llm import queries as q


def components(ids, pairs):
    """The least member of each id's group."""
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def tokenizer(name):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(q.tokenizer_path(name))
    t.encode_special_tokens = True
    return t


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())
