"""How much the token files' encoder works on at a time."""

import public_tokenizers

from meterline.llm import token_files


def test_few_texts_are_encoded_at_a_time(monkeypatch):
    encoder = token_files.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    sizes, merge = [], encoder._merged

    def merged(pieces):
        sizes.append(len(pieces))
        return merge(pieces)

    monkeypatch.setattr(encoder, "_merged", merged)
    texts = [f" w{number}q" for number in range(21)] + ["", "two<|endoftext|>parts", "\U0001ccd6 new"]
    assert encoder.encode(texts) == encoder._ids(texts)
    assert encoder.encode([]) == [] and encoder.encode(texts[::-1]) == encoder._ids(texts[::-1])
    assert max(sizes) <= 3 * token_files.TEXTS  # each text has three pieces
