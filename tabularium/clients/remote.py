"""Clients for frames of requests: each partition owns a key pool, and a request that fails leaves its error in its row. Offline stubs stand in for services."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd

from . import keys as K


def pooled(keys: list[str], send: Callable[[str, str], str], wait: bool = True, attempts: int = K.ATTEMPTS) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A client for ``enrich.called``: ``send(key, prompt)`` of each row's prompt, with keys rotated within the partition."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pool = K.KeyPool(list(keys))
        for frame in frames:
            replies, errors = [], []
            for prompt in frame["prompt"]:
                try:
                    replies.append(K.call(pool, lambda key, p=prompt: send(key, p), wait, attempts))
                    errors.append(None)
                except Exception as why:  # the row keeps it; the others go on
                    replies.append(None)
                    errors.append(f"{type(why).__name__}: {why}")
            yield frame.assign(reply=replies, error=errors)

    return run


def stub_recogniser(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Stands in for recognition, offline: a line for each page of (name, start, stop)."""
    for frame in frames:
        texts = ["\n".join(f"{name} {page + 1}" for page in range(a, b)) for name, a, b in zip(frame["name"], frame["start"], frame["stop"], strict=True)]
        yield pd.DataFrame({"name": frame["name"], "start": frame["start"], "text": texts})


def stub_cutter(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Stands in for semantic cutting, offline: a JSON list of parts of as many words as the prompt allows."""
    import re

    for frame in frames:
        replies = []
        for prompt in frame["prompt"]:
            limit, text = re.match(r'<article .*? limit="(\d+)">\n(.*)\n</article>$', prompt, re.S).groups()
            words = text.split()
            replies.append(json.dumps([" ".join(words[k : k + int(limit)]) for k in range(0, len(words), int(limit))], ensure_ascii=False))
        yield frame.assign(reply=replies, error=None)
