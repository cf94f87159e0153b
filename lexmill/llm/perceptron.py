"""An averaged perceptron that ranks candidates by sparse features."""

from __future__ import annotations

import random
from array import array
from collections.abc import Iterable

#: By how much the right candidate must lead in training.
MARGIN = 1.0


class AveragedPerceptron:
    """Weights of features; the average over all steps is what scores."""

    def __init__(self, weights: dict[str, float] | None = None) -> None:
        self.weights: dict[str, float] = weights or {}

    def score(self, features: list[str]) -> float:
        get = self.weights.get
        return sum(get(f, 0.0) for f in features)

    def best(self, candidates: list[list[str]]) -> int:
        """The best of the candidates, each a list of features; the first of equal ones."""
        return max(range(len(candidates)), key=lambda i: (self.score(candidates[i]), -i))

    def train(self, examples: Iterable[tuple[list[list[str]], int]], rounds: int = 6, seed: int = 0) -> AveragedPerceptron:
        """``examples``: candidates and the number of the right one; they are held as numbers of their features."""
        numbers: dict[str, int] = {}
        held = [([array("i", [numbers.setdefault(f, len(numbers)) for f in c]) for c in candidates], right) for candidates, right in examples]
        n = len(numbers)
        weights, total, stamp = [0.0] * n, [0.0] * n, [0] * n
        step, order, rng = 0, list(range(len(held))), random.Random(seed)
        weight = weights.__getitem__

        def add(features: array, by: float) -> None:
            for f in features:
                total[f] += (step - stamp[f]) * weights[f]
                stamp[f] = step
                weights[f] += by

        for _ in range(rounds):
            rng.shuffle(order)
            for k in order:
                step += 1
                candidates, right = held[k]
                scores = [sum(map(weight, c)) for c in candidates]
                mine = scores[right]
                scores[right] = float("-inf")
                found = scores.index(max(scores))
                if found != right and mine - scores[found] < MARGIN:
                    add(candidates[right], 1.0)
                    add(candidates[found], -1.0)
        add(array("i", range(n)), 0.0)
        self.weights = {f: total[i] / max(step, 1) for f, i in numbers.items() if total[i]}
        return self
