from shardloom.plans.build import BuildResult, build_index
from shardloom.plans.cutover import CutoverResult, cut_over, publish
from shardloom.plans.upkeep import delete_documents, merge_shards, merged_field_stats, store_statistics

__all__ = ["BuildResult", "CutoverResult", "build_index", "cut_over", "delete_documents", "merge_shards",
           "merged_field_stats", "publish", "store_statistics"]
