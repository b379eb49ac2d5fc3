"""DataFrame-to-DataFrame building blocks shared by every plan."""
