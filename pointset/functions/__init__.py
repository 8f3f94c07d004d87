from .random import bound_digits, digits_of, draw_start, exponential_race, uniform
from .vector import dim_of, sq_dist, tag_dim, vector_literal

__all__ = [
    "bound_digits",
    "digits_of",
    "dim_of",
    "draw_start",
    "exponential_race",
    "sq_dist",
    "tag_dim",
    "uniform",
    "vector_literal",
]
