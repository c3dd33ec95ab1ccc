"""Table schemas as DDL."""

POINT = "struct<x:double,y:double>"
DETECTIONS = f"array<struct<text_idx:int,text:string,poly:array<{POINT}>>>"
ZONES = "array<struct<x_min:double,x_max:double,y_min:double,y_max:double>>"
ORDERS = "order_id string, lob string, img_1 string, img_2 string, img_3 string, img_4 string"
PHOTOS = f"order_id string, image_idx int, url string, img_w int, img_h int, status string, detections {DETECTIONS}, stamp_texts array<string>, box struct<x:int,y:int,w:int,h:int,method:string>"
RULES = f"lob string, sticker_count string, scan_zones {ZONES}, auth_zones {ZONES}, aspect_lo double, aspect_hi double, color struct<enabled:boolean,mode:string,area_ratio:double,solidity_min:double,edge_grad_min:double>"
#: The verdict's columns, in their order.
VERDICT = (
    "lob", "is_compliant", "seal_exists", "position_valid", "rel_x", "rel_y", "sticker_angle", "box_method", "rectify_method", "box_quad_src",
    "color_checked", "color_mode", "detail", "dual_code", "dual_detail", "stamp_time", "stamp_place",
)
