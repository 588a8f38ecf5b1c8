"""Field-survey and mark-recapture data work as lazy Spark DataFrame functions."""
