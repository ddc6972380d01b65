"""Demand forecasts for every series in one job.

All forecasts share one long form: store, product, model, mode, sale_date,
actual, predicted. ``mode`` is ``one_step`` where a prediction saw the real
units up to the day before, ``multi_step`` where it saw the training part only.
"""

FORECAST_COLUMNS = ["store", "product", "model", "mode", "sale_date", "actual", "predicted"]
ONE_STEP, MULTI_STEP = "one_step", "multi_step"
