"""spark-submit run_aggregate.py --root hdfs:///orders"""

from ordertide.streaming.jobs import aggregate

if __name__ == "__main__":
    aggregate()
