"""Inspection analytics on Spark: review-loop metrics, calibration, mask algebra, splits and gates."""
