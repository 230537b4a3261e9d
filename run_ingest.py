"""spark-submit run_ingest.py --root hdfs:///orders --bootstrap broker:9092 --topic orders.raw"""

from ordertide.streaming.jobs import ingest

if __name__ == "__main__":
    ingest()
