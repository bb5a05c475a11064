from pairloom.plans.jobs import DAILY, add_counts, add_events, count_events, embed_matrix, reduce_matrix

__all__ = ["DAILY", "add_counts", "add_events", "count_events", "embed_matrix", "reduce_matrix"]
