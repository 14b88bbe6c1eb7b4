"""Double-valued output columns of the registered queries that have a SQL twin.

Generated from the Spark schemas (see tests/test_oracle.py, which keeps it current);
both sides round these columns to 6 decimals before the comparison.
"""

DOUBLE_COLUMNS = {
    'a10_campaign_csv': ['churn_probability'],
    'f14_compare_stored': ['accuracy', 'precision', 'recall', 'f1', 'roc_auc', 'pr_auc', 'latency_ms'],
    'h8_control_arms_by_model': ['rate'],
    'a7_latest_records': ['precision', 'recall'],
    'a8_result_documents': ['accuracy'],
    'h10_psi_all_features': ['psi'],
    'h10_stream_event_drift': ['psi'],
    'a10_campaign_export': ['churn_probability'],
    'a1_csv_roundtrip': ['fee', 'avg_value', 'wait_days'],
    'a5_processed_sink': ['fee', 'avg_value', 'wait_days'],
    'a6_scored_set_roundtrip': ['y_score'],
    'a7_result_upsert': ['threshold', 'precision', 'recall'],
    'a8_read_results': ['accuracy'],
    'b12_rate_by_category': ['rate', 'rate_pct'],
    'b13_stats_by_target': ['mean', 'median', 'std', 'min', 'max'],
    'b14_mean_contrast': ['mean_0', 'mean_1', 'diff', 'diff_pct'],
    'b15_corr_with_target': ['corr', 'abs_corr'],
    'b16_corr_matrix': ['r'],
    'b17_class_balance': ['pct'],
    'b18_imbalance': ['ratio'],
    'b19_describe': ['mean', 'std', 'min', 'q25', 'q50', 'q75', 'max'],
    'b21_quantiles': ['q25', 'q75'],
    'b22_rate_spread': ['min_rate', 'max_rate', 'spread'],
    'b23_behaviour_contrast': ['retained_mean', 'churned_mean'],
    'b3_missing': ['ratio'],
    'b6_iqr_outliers': ['q1', 'q3', 'lower', 'upper', 'outlier_pct'],
    'b7_box_stats': ['q1', 'median', 'q3', 'whisker_low', 'whisker_high'],
    'b8_histogram': ['lo', 'hi'],
    'c10_to_numeric': ['visits_num'],
    'c11_standard_scaler': ['fee', 'visits', 'avg_value'],
    'c12_robust_scaler': ['urgent', 'returns'],
    'c13_median_imputer': ['avg_value', 'returns', 'wait_days'],
    'c15_column_transformer': ['value'],
    'c16_to_xy': ['fee', 'avg_value', 'wait_days'],
    'c1_fill_constants': ['fee', 'avg_value', 'wait_days'],
    'c20_top_half_features': ['importance'],
    'c21_risk_grade': ['y_score'],
    'c2_drop_columns': ['avg_value', 'wait_days'],
    'c7_onehot_first_drop': ['fee', 'avg_value', 'wait_days'],
    'c9_deployment_features': ['visits', 'returns'],
    'd1_stratified_split': ['fee', 'avg_value', 'wait_days'],
    'd2_three_way_split': ['fee', 'avg_value', 'wait_days'],
    'd3_train_subsample': ['fee', 'avg_value', 'wait_days'],
    'd4_even_sample': ['fee', 'avg_value', 'wait_days'],
    'd5_head': ['fee', 'avg_value', 'wait_days'],
    'e11_majority_baseline': ['baseline_accuracy'],
    'e14_stored_score_decisions': ['churn_probability', 'threshold'],
    'e8_knn_uniform': ['knn_score'],
    'e9_knn_distance': ['knn_score'],
    'f11_metric_bundle': ['threshold', 'accuracy', 'precision', 'recall', 'f1', 'roc_auc', 'pr_auc'],
    'f12_threshold_sweep': ['threshold', 'accuracy', 'precision', 'recall', 'f1'],
    'f14_compare': ['accuracy', 'precision', 'recall', 'f1', 'roc_auc', 'pr_auc'],
    'f15_grouped_metrics': ['threshold', 'accuracy', 'precision', 'recall', 'f1', 'roc_auc', 'pr_auc'],
    'f1_predictions': ['y_score'],
    'f3_classification_metrics': ['accuracy', 'precision', 'recall', 'f1'],
    'f4_roc_auc': ['roc_auc'],
    'f4_roc_auc_churn_label': ['roc_auc'],
    'f5_average_precision': ['pr_auc'],
    'f6_roc_curve': ['threshold', 'fpr', 'tpr'],
    'f6_roc_curve_thinned': ['threshold', 'fpr', 'tpr'],
    'f7_pr_curve': ['threshold', 'precision', 'recall'],
    'f8_trapezoid_roc_area': ['area'],
    'f9_best_f1_threshold': ['threshold', 'f1'],
    'g10_scale_counts': ['selected_share', 'selected_per_1000', 'tp_per_1000', 'fp_per_1000', 'fn_per_1000', 'tn_per_1000'],
    'g1_business_score': ['business_score'],
    'g2_rank_models': ['business_score'],
    'g3_candidates': ['churn_probability'],
    'g3_candidates_large_capacity': ['churn_probability'],
    'g4_campaign_status': ['y_score'],
    'g6_risk_level': ['y_score'],
    'g8_churn_decision': ['y_score', 'threshold'],
    'h10_psi': ['base_share', 'current_share', 'psi'],
    'h10_stream_event_activity': ['sum_value'],
    'h1_lift_table': ['min_score', 'churn_rate', 'cum_capture', 'lift'],
    'h4_members': ['fee', 'avg_value', 'wait_days'],
    'h5_join_audit': ['null_rate'],
    'h7_exclusions': ['churn_probability'],
    'h8_control_arms': ['rate'],
    'h9_undersample': ['fee', 'avg_value', 'wait_days'],
}
