"""The semantics again, in plain Python, one row at a time."""

import numpy as np

from widevec.testing import token_vectors


def byte_ids(text, max_len=None):
    content = (text or "").encode("utf-8", "surrogatepass")
    if max_len is None:
        return [b + 3 for b in content] + [1]
    real = [b + 3 for b in content[: max_len - 1]] + [1]
    return real + [0] * (max_len - len(real))


def byte_mask(text, max_len):
    real = min(len((text or "").encode()), max_len - 1) + 1
    return [1] * real + [0] * (max_len - real)


def cut_and_pad(ids, max_len):
    kept = ids[:max_len]
    return kept + [0] * (max_len - len(kept)), [1] * len(kept) + [0] * (max_len - len(kept))


def pool(hidden, mask, mode):
    if mode == "cls":
        return list(hidden[0])
    out = []
    for d in range(len(hidden[0])):
        if mode == "max":
            out.append(max(h[d] if m else -1e9 for h, m in zip(hidden, mask)))
        else:
            out.append(sum(h[d] * m for h, m in zip(hidden, mask)) / max(sum(mask), 1e-9))
    return out


def byte_vector(text, max_len, width=8):
    table = token_vectors(259, width)
    real = [i for i in byte_ids(text, max_len) if i]
    return [float(np.float32(sum(table[i][d] for i in real)) / np.float32(len(real))) for d in range(width)]
