"""netquery: Spark-native network-data analytics.

Connection-record features and detection models, telemetry and command-log
analytics (batch and Structured Streaming), and shared-link fairness and
delay measures, all expressed with DataFrame / SQL / ML APIs.
"""

__version__ = "0.1.0"
