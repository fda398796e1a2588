"""Column names of the files that come without a header, and of the yearly sheets.

Fixed values: names and their order are the formats of the files.
"""

from __future__ import annotations

# On-hand file of two units, 67 columns.
STOCK_FILE = (
    "msstor", "msstrn", "mstrnc", "mstrnd", "mstype", "msvdno", "msvdnm", "msdept", "msdptn", "mssdpt",
    "mssdpn", "msbrnd", "msclas", "msclsn", "msscls", "msscln", "mssku", "mssdes", "msibc", "mssbc",
    "mspopg", "mscatl", "msskus", "msstkr", "msstkc", "msstoh", "msregp", "msorgp", "msancp", "msascn",
    "msasdt", "mspoor", "mstoor", "msrtvv", "msrtvi", "msdist", "msobsf", "msmqty", "msage", "msaget",
    "att_nam_1", "att_val_1", "att_desc_1", "att_nam_2", "att_val_2", "att_desc_2", "att_nam_3",
    "att_val_3", "att_desc_3", "att_nam_4", "att_val_4", "att_desc_4", "att_nam_5", "att_val_5",
    "att_desc_5", "att_nam_6", "att_val_6", "att_desc_6", "att_nam_7", "att_val_7", "att_desc_7",
    "preord", "mbyum", "mslum", "mstdpk", "rpl_code", "special_attribute",
)

# On-hand file of a third unit.
STORE_STOCK_FILE = (
    "store", "store_name", "t_c", "t_date", "sku_t", "vendor", "vendor_name", "dept", "dept_name",
    "sub_dept", "sub_dept_name", "brand_description", "class", "class_name", "sub_class",
    "sub_class_name", "sku", "sku_description", "ibc", "sbc", "popg", "catalogue", "sts",
    "stock_retail", "stock_cost", "soh", "reg_ret", "ori_ret", "ancp", "c", "as_of_date", "po_on_ord",
    "to_on_ord", "rtv_vnd", "rtv_item", "dis_typ", "color_desc", "size_desc",
    "att_nam_1", "att_val_1", "att_desc_1", "att_nam_2", "att_val_2", "att_desc_2", "att_nam_3",
    "att_val_3", "att_desc_3", "att_nam_4", "att_val_4", "att_desc_4", "att_nam_5", "att_val_5",
    "att_desc_5", "att_nam_6", "att_val_6", "att_desc_6", "att_nam_7", "att_val_7", "att_desc_7",
    "preord", "mbyum", "mslum", "mstdpk", "unavail_qty", "avail_qty",
)

# Item master, 186 columns.
ITEM_MASTER = (
    "vendor", "v_name", "vndsts", "dept", "dept_name", "sub_dpt", "s_dpt_name", "class", "class_name",
    "sub_cls", "s_cls_name", "sku_no", "sku_descr", "derived_description", "short_description",
    "pos_description", "brand_id", "brand_no", "brand_desc", "buyer", "merchandiser", "set_code",
    "posdwn", "distribution_type", "delivery_type", "pop_grade", "catalogue", "mfg_part_no",
    "code_color", "color", "color_des", "code_size", "size", "size_des", "home_cost", "reg_cost",
    "reg_retail", "org_price", "buy_um", "sell_um", "packsize", "inner_pack", "discount_t",
    "sku_status", "i_auto", "i_manual", "sku_type", "rpl_code", "minrplqty", "display_minimum",
    "maximum_stock", "expec_first_receive", "distribute", "plan_week", "week_supply", "sea", "gm",
    "vat_flag", "isbn", "author", "translator", "year_edit", "edition_no", "page_no", "cover", "weight",
    "length", "width", "height", "planogram", "cluster", "rtv_by_itm", "rtv_vendor", "special",
    "expi_date", "ibc", "sbc#1", "sbc#2", "sbc#3", "sbc#4", "sbc#5", "creat_date", "create_by",
    "last_maintain_date", "sku_lead_time", "top_sale_company",
    "att_nam1", "att_val1", "att_dsc1", "att_nam2", "att_val2", "att_dsc2", "att_nam3", "att_val3",
    "att_dsc3", "att_nam4", "att_val4", "att_dsc4", "att_nam5", "att_val5", "att_dsc5", "att_nam6",
    "att_val6", "att_dsc6", "att_nam7", "att_val7", "att_dsc7", "att_nam8", "att_val8", "att_dsc8",
    "att_nam9", "att_val9", "att_dsc9", "att_nam10", "att_val10", "att_dsc10", "att_nam11", "att_val11",
    "att_dsc11", "att_nam12", "att_val12", "att_dsc12", "att_nam13", "att_val13", "att_dsc13",
    "att_nam14", "att_val14", "att_dsc14", "att_nam15", "att_val15", "att_dsc15",
    "soh_chain", "trf_on_order", "po_on_order", "avg_8wk_sale", "cur_w_sale",
    "wks_sale_01", "wks_sale_02", "wks_sale_03", "wks_sale_04", "wks_sale_05", "wks_sale_06",
    "wks_sale_07", "wks_sale_08",
    "po_comment_1", "po_comment_2", "po_comment_3",
    "thai_spec_01", "thai_spec_02", "thai_spec_03", "thai_spec_04", "thai_spec_05", "thai_spec_06",
    "thai_spec_07", "thai_spec_08", "thai_spec_09", "thai_spec_10", "thai_spec_11", "thai_spec_12",
    "eng_spec_01", "eng_spec_02", "eng_spec_03", "eng_spec_04", "eng_spec_05", "eng_spec_06",
    "eng_spec_07", "eng_spec_08", "eng_spec_09", "eng_spec_10", "eng_spec_11", "eng_spec_12",
    "size_range", "size_range_name", "option_code", "option_name", "style_cg", "season_start",
    "brand_group", "brand_group_name", "lifecycle_code", "lifecycle_name",
    "mupc#1", "mupc#2", "mupc#3", "mupc#4", "mupc#5",
)

# Pipe-separated stocktake master.
STOCKTAKE_MASTER = (
    "cyclecount", "stcode", "barcode", "description", "dept", "deptname", "subdept", "subdeptname",
    "soh", "pack", "cost", "price", "status",
)

# Scan-count master with one leading line.
SCAN_MASTER = (
    "stcode", "cntnum", "barcode", "sku", "description", "pack", "qnt", "price", "location", "sdate", "stime",
)

# Header names of the wholesale on-hand sheet.
WHOLESALE_STOCK = {
    "รหัสกลุ่มลูกค้า": "groupcuscode",
    "ชื่อกลุ่มลูกค้า": "groupcuname",
    "รหัสลูกค้า": "cuscode",
    "ชื่อลูกค้า": "cusname",
    "ชื่อสั้นลูกค้า": "cusssname",
    "SKU": "sku",
    "Barcode IBC": "barcodeibc",
    "Barcode SBC": "barcodesbc",
    "ชื่อสินค้า": "description",
    "ยี่ห้อ": "brand",
    "รุ่น": "model",
    "สี": "colour",
    "ขนาด": "size",
    "Stock": "soh",
    "จำนวนคงค้างออก Pre-order CN": "preordercn",
    "ราคาปกติ": "retail",
    "ราคา Promotion": "retailpromotion",
    "GP ปกติ": "gp",
    "GP Promotion": "gppromotion",
    "ราคาทุนต่อหน่วย": "cost",
    "รหัส Dept": "dept",
    "ชื่อ Dept": "deptname",
    "รหัส Sub Dept": "sdept",
    "ชื่อ Sub Dept": "sdeptname",
    "รหัส Class": "class",
    "ชื่อ Class": "classname",
    "รหัส Sub Class": "sclass",
    "ชื่อ Sub Class": "sclassname",
    "วันที่แสดงข้อมูล": "data_date",
}

# Header names of the yearly plan sheet, the columns kept, and those in which an empty cell is 0.
YEARLY_PLAN = {
    "No": "no",
    "BUs.": "bu",
    "Acronym": "acronym",
    "Store Code": "stcode",
    "Branch": "branch",
    "Province": "province",
    "HUB": "shub",
    "FOOD": "food_soh",
    "NONFOOD": "nonfood_soh",
    "PERISHABLE": "perishable_soh",
    "Total SOH": "total_soh",
    "Size": "size",
    "Type": "type1",
    "Atype": "atype",
    "Total EST.Man": "est_man_total",
    "EST.ManControl": "est_man_control",
    "EST.ManExpire": "est_man_expire",
    "EST.ManCount": "est_man_count",
    "CNTDATE": "cntdate",
    "Day": "day",
    "Month": "month",
    "Total PlanManday": "div_pman_total",
    "Manday Control": "div_pman_control",
    "Manday Expire2": "div_pman_expire",
    "Manday Count": "div_pman_count",
    "ManStore": "div_pman_store",
    "Outsource": "div_cman_outsource",
    "Part-Time local": "div_pman_pt",
    "Outsource By DIV": "div_pman_outsource",
    "Status การจ้าง Outsource": "hiring_outsource",
    "ประเภทการตรวจนับ": "outsource_cnt_type",
    "Round": "round",
    "Status2": "job_status",
    "POST Date": "post_date",
    "Case LP No": "case_lp_no",
    "Case LP Date": "case_lp_date",
    "Code For Copy": "code_for_copy",
}
YEARLY_PLAN_COLUMNS = tuple(YEARLY_PLAN.values())
YEARLY_PLAN_ZERO = (
    "est_man_total", "est_man_control", "est_man_expire", "est_man_count", "div_pman_control",
    "div_pman_count", "div_pman_expire", "div_pman_store", "div_cman_outsource", "div_pman_outsource",
    "div_pman_pt", "div_pman_total",
)
