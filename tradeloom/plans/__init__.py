"""Named results as lazy DataFrame functions."""
