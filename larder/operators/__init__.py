"""DataFrame-to-DataFrame operators: nothing here reads, writes or collects,
except the gates in ``quality``, which run one aggregate and raise."""
