"""DataFrame operators: frequencies, shares, points, series, histograms, blocks,
sessions and user encoding."""
