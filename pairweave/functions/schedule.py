"""Learning-rate and teacher-forcing schedules as closed forms of the step number."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

LR_MAX, LR_MIN = 5e-4, 5e-6
TEACHER_MAX, TEACHER_MIN = 1.0, 0.5


def cosine_anneal(step: Column, period: Column, high: float, low: float) -> Column:
    """Half a cosine from ``high`` at step 0 to ``low`` at ``period``, and back up beyond it."""
    return F.lit(low) + (high - low) * (1 + F.cos(F.pi() * step / period)) / 2


def lr_at(step: Column, iterations: Column) -> Column:
    """Learning rate of a global step; falls over two epochs, then rises for two."""
    return cosine_anneal(step, 2 * iterations, LR_MAX, LR_MIN)


def annealed_steps(epoch: Column, step_in_epoch: Column, iterations: Column) -> Column:
    """Steps already taken in epochs that anneal teacher forcing, i.e. all but every third epoch from 0."""
    finished = epoch - F.floor((epoch + 2) / 3)
    inside = F.when(epoch % 3 == 0, F.lit(0)).otherwise(step_in_epoch)
    return finished * iterations + inside


def teacher_ratio(epoch: Column, step_in_epoch: Column, iterations: Column) -> Column:
    """Share of decoder inputs taken from the target: 1 in every third epoch, else annealed."""
    steps = annealed_steps(epoch, step_in_epoch, iterations)
    annealed = cosine_anneal(steps, iterations, TEACHER_MAX, TEACHER_MIN)
    return F.when(epoch % 3 == 0, F.lit(1.0)).otherwise(annealed)
