"""DataFrame transformations: merges, groups, reshapes, rankings, evaluation."""
