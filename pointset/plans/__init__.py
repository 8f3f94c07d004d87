from .cluster import Clustering, cluster, evaluate, numeric_points, prepare, sweep

__all__ = ["Clustering", "cluster", "evaluate", "numeric_points", "prepare", "sweep"]
