"""Order-dependent rules over the epochs of a run, one step at a time.

The same rules end a training while it runs and are read off a finished history.  A missing
value is no gain; a best value is only replaced by one that is better by the gain asked for,
so neither is a running extreme.
"""

from __future__ import annotations


class Patience:
    """Stop rule: so many steps in a row without a gain; remembers the best step."""

    def __init__(self, patience: int, gain: float = 0.0, maximize: bool = True):
        self.patience, self.gain, self.sign = patience, float(gain), 1.0 if maximize else -1.0
        self.best: float | None = None
        self.best_step: int | None = None
        self.last_step: int | None = None
        self.waited = 0

    def goes_on(self, step: int, value: float | None) -> bool:
        """Take note of a step's value; False when it is time to stop."""
        self.last_step = step
        better = value is not None and self.best is not None and value * self.sign > self.best * self.sign + self.gain
        if self.best is None or better:
            self.best, self.best_step, self.waited = value, step, 0
        else:
            self.waited += 1
        return self.waited < self.patience


class Plateau:
    """Learning rate that is cut when a minimised value stops falling, down to a floor."""

    def __init__(self, rate: float, factor: float = 0.5, patience: int = 5, floor: float = 1e-6, gain: float = 1e-4):
        self.rate, self.factor, self.floor, self.patience = rate, factor, floor, patience
        self.watch = Patience(patience, gain, maximize=False)

    def step(self, step: int, value: float | None) -> float:
        """The rate behind this step."""
        if not self.watch.goes_on(step, value) and self.rate > self.floor:
            self.rate, self.watch.waited = max(self.rate * self.factor, self.floor), 0
        return self.rate
