"""The piece table of a SentencePiece model, and how a text falls into independent words.

The table's scores are read as the weights of a unigram model, whose best segmentation is the one
with the highest sum. The model gives runs of spaces a placeholder for a score; here they weigh one
less than the lightest real piece. A character without a piece weighs ten less than the lightest
piece and becomes its UTF-8 bytes.

A text is prefixed by a space, and spaces become U+2581. No piece contains U+2581 behind another
character and none contains a line feed, so the best segmentation of a text is that of its words: a
run of U+2581 with what follows up to the next one, or a line feed. By the same reasoning ``Cutter``
cuts words further, wherever no piece holds two neighbouring characters side by side.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np

#: Where the vocabulary lies unless the caller names another file.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
_PLACEHOLDER = -1e8
_UNKNOWN_PENALTY = 10.0
_WORDS = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")


@dataclass(frozen=True)
class Pieces:
    """Pieces with their scores and ids, the ids of single bytes, and the unknown weight."""

    scores: dict[str, float]
    ids: dict[str, int]
    byte_ids: tuple[int, ...]
    unknown: float

    @property
    def longest(self) -> int:
        return max(map(len, self.scores))

    def bytes_of(self) -> dict[int, bytes]:
        """The bytes that each id stands for."""
        known = {i: p.replace(SPACE, " ").encode() for p, i in self.ids.items()}
        return known | {i: bytes([b]) for b, i in enumerate(self.byte_ids)}


def load_pieces(model: str = MODEL) -> Pieces:
    from sentencepiece import SentencePieceProcessor

    read = SentencePieceProcessor(model_file=model)
    scores, ids, bytes_ = {}, {}, {}
    for number in range(read.get_piece_size()):
        piece = read.id_to_piece(number)
        if read.is_byte(number):
            bytes_[int(piece[1:-1], 16)] = number
        elif not (read.is_control(number) or read.is_unknown(number) or read.is_unused(number)):
            scores[piece], ids[piece] = read.get_score(number), number
    lightest = min(s for s in scores.values() if s > _PLACEHOLDER) - 1
    scores = {piece: max(score, lightest) for piece, score in scores.items()}
    for piece in scores:
        if SPACE in piece.lstrip(SPACE) or ("\n" in piece and piece != "\n"):
            raise ValueError(f"piece {piece!r} crosses words")
    if len(bytes_) != 256:
        raise ValueError("the model has no byte pieces")
    return Pieces(
        scores, ids, tuple(bytes_[b] for b in range(256)), min(scores.values()) - _UNKNOWN_PENALTY
    )


def words_of(text: str | None) -> list[str]:
    """The words of a text; null and empty texts have none."""
    return _WORDS.findall(SPACE + text.replace(" ", SPACE)) if text else []


class Cutter:
    """Cuts texts into the parts that the best segmentation treats one by one.

    A part ends wherever no piece has the two neighbouring characters in this order, so no piece
    crosses a cut and the parts' segmentations together are the text's.
    """

    def __init__(self, pieces: Pieces):
        pairs = {p[i : i + 2] for p in pieces.scores for i in range(len(p) - 1)}
        numbers = {c: i for i, c in enumerate(sorted(set("".join(pairs))), 1)}
        # Number 0 stands for characters that are only pieces of their own, or none.
        self._number = np.zeros(0x110000, dtype=np.uint16)
        for character, number in numbers.items():
            self._number[ord(character)] = number
        self._together = np.zeros((len(numbers) + 1, len(numbers) + 1), dtype=bool)
        for first, second in pairs:
            self._together[numbers[first], numbers[second]] = True

    def parts(self, text: str | None) -> list[str]:
        """The parts of a text in order; null and empty texts have none."""
        if not text:
            return []
        text = SPACE + text.replace(" ", SPACE)
        numbers = self._number[np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)]
        cuts = (np.flatnonzero(~self._together[numbers[:-1], numbers[1:]]) + 1).tolist()
        return [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
