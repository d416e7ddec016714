"""Products over streams: daily counts with a watermark (``daily``) and hot
words of a line stream (``hotwords``)."""
