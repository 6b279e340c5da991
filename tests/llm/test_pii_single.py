"""A mention that stands once is scored by its features and neighbours, with no repeat in the document."""

import numpy as np

from venuelake.llm import pii_crf


def model_for(text, kind):
    mentions = pii_crf.Mentions(text, pii_crf.base_spans(text))
    node = np.zeros((mentions.features.shape[1], pii_crf.STATES))
    node[:, kind + 1] = 20 * (mentions.features > 0).any(axis=0)
    flat = np.zeros((pii_crf.STATES, pii_crf.STATES))
    return mentions, {"node": node, "chain": flat, "skip": flat}


def test_mention_that_stands_once_is_scored():
    for text in ("Ref 12 34 567 end", "Call us at 555 1234 today"):
        mentions, model = model_for(text, 3)
        hidden = [mentions.spans[i] for i in np.flatnonzero(mentions.evidence < 0)]
        assert hidden and not len(mentions.skip)
        assert {(a, b) for _, a, b in pii_crf.added_spans(text, pii_crf.base_spans(text), model)} == {tuple(x) for x in hidden}
        model["node"][:] = 0
        assert pii_crf.added_spans(text, pii_crf.base_spans(text), model) == []
