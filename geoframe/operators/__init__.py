"""DataFrame operators on labelled grids, swaths, forecasts and station series."""
