"""Analytics on partitioned, ordered record logs, written as Spark jobs."""
